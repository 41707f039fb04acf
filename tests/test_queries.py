from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry
from check import TABLES, rows

from presspulse.plans import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 550 and df.columns[:3] == ["Ticker", "Company", "News_Date"]


def test_every_query_is_offered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"train_price_models", "ml_predictions"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_statement(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = sql.execute(ORACLES[name])
    want = rows([d[0] for d in cursor.description], cursor.fetchall())
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_statement_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
