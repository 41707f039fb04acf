from __future__ import annotations

import re

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from helpers import FOLDER, HAS_TABLES, docs, table
from test_near_dedup import brute as classes
from test_pii import brute as personal
from tokenizers import Tokenizer

import __spark_entry__ as entry
from presspulse.llm import queries

pytestmark = pytest.mark.skipif(not HAS_TABLES, reason="test tables are not there")
LABELS = "doc_id long, quality int, toxic int"


def plain(text):
    return " " + " ".join(re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())) + " "


def test_stages_one_by_one(spark, tmp_path):
    rows = table(spark, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, rows, FOLDER).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert after.columns == table(spark, "documents").columns
            kept.append((name, {r.doc_id: r.text for r in rows.collect()}, {r.doc_id: r for r in after.collect()}))
            rows = after
    held = {name: (before, after) for name, before, after in kept}

    before, after = held["toxicity"]
    labels = {r.doc_id: r.toxic for r in table(spark, "labels").collect()}
    wrong = [i for i in before if i in labels and (i in after) == bool(labels[i])]
    assert len(wrong) <= 3

    before, after = held["near_dedup"]
    of = classes(list(before.items()))
    assert set(after) == {c for i, c in of.items()} == {i for i in before if of[i] == i}

    before, after = held["decontamination"]
    items = [plain(r.text) for r in table(spark, "benchmark").collect()]
    assert set(after) == {i for i, t in before.items() if not any(q in plain(t) for q in items)}

    before, after = held["pii"]
    assert set(after) == set(before)
    for i, r in after.items():
        assert not personal(r.text) and r.n_chars == len(r.text)
        if not personal(before[i]) and "token" not in before[i]:
            assert r.text == before[i]

    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = spark.read.parquet(f"{tmp_path}/packing").toPandas()
    want = {r.doc_id: len(tokens.encode(r.text, add_special_tokens=False).ids) + 1 for r in rows.collect()}
    assert pieces.groupby("doc_id").length.sum().to_dict() == want
    totals = pieces.groupby("sequence_id").length.sum().to_numpy()
    assert np.isin(totals, 2 ** np.arange(12)).all()


def test_awkward_tables(spark, tmp_path):
    rows = docs(spark, [(1, None), (2, ""), (3, "only a few words"), (3, "only a few words"), (None, "no id")])
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0) for r in got if r.start == 0) == [0, 1, 2, 3]
    docs(spark, []).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_offered():
    offered = entry.queries()
    assert set(queries.QUERIES) <= set(offered) and "pipeline" in offered
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_statement(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    cursor = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    got = queries.QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(cursor.fetchall())
