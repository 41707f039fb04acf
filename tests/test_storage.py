from __future__ import annotations

import datetime as dt
import random
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presspulse import config as C
from presspulse.functions.text import stable_hash
from presspulse.operators import enrich as E
from presspulse.operators import news as N
from presspulse.operators.daily import DAY
from presspulse.plans import jobs as J
from presspulse.sources import storage as ST
from presspulse.streaming import ingest
from presspulse.streaming.ingest import ingest_articles, ingest_batch, surviving_articles

TABLE = T.StructType([T.StructField("News_Date", T.DateType()), T.StructField("k", T.StringType()), T.StructField("v", T.DoubleType())])


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    assert ST.read_or_empty(spark, path, TABLE).count() == 0
    day = lambda n: dt.date(2025, 1, n)
    rows = lambda *r: spark.createDataFrame(r, "News_Date date, k string, v double")
    ST.append_rows(rows((day(1), "a", 1.0), (day(2), "b", 2.0)), path, TABLE)
    ST.append_rows(rows((day(1), "a", 1.0)).drop("v").withColumn("other", F.lit(1)), path, TABLE)
    got = lambda: {(r["News_Date"].day, r["k"], r["v"]) for r in ST.read_or_empty(spark, path, TABLE).collect()}
    assert got() == {(1, "a", 1.0), (1, "a", None), (2, "b", 2.0)}
    ST.replace_days(rows((day(1), "c", 3.0)), path, TABLE)  # a repeated run replaces its own day only
    ST.replace_days(rows((day(1), "c", 3.0)), path, TABLE)
    assert got() == {(1, "c", 3.0), (2, "b", 2.0)}
    assert ST.read_or_empty(spark, path, TABLE).count() == 2


def test_missing_csv_is_empty_and_present_csv_is_typed(spark, tmp_path):
    path = str(tmp_path / "c")
    assert ST.read_or_empty(spark, path, TABLE, "csv").schema == TABLE
    ST.write_csv(spark.createDataFrame([(dt.date(2025, 1, 1), "x, \"y\"", 0.1)], TABLE), path)
    assert tuple(ST.read_or_empty(spark, path, TABLE, "csv").first()) == (dt.date(2025, 1, 1), 'x, "y"', 0.1)


def test_broadcast_only_below_the_limit(spark):
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in plan(ST.broadcast_if_small(spark.range(10), 10))
    assert "ResolvedHint" not in plan(ST.broadcast_if_small(spark.range(11), 10))


def test_shared_dir_is_the_configured_one(spark):
    assert ST.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert ST.new_path(spark, "x") != ST.new_path(spark, "x")


def test_only_cache_misses_are_computed(spark, tmp_path):
    path = str(tmp_path / "cache")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "b", "a", "", None, "c"])], "id int, text string")
    seen = []

    def scorer(texts):
        seen.append(sorted(r["text"] for r in texts.collect()))
        return texts.withColumn("embedding", F.array(F.length("text").cast("double")))

    E.enrich(df.where("text = 'a'"), "text", path, E.EMBEDDINGS, scorer)
    out = {r["id"]: r["embedding"] for r in E.enrich(df, "text", path, E.EMBEDDINGS, scorer).collect()}
    assert seen == [["a"], ["b", "c"]]
    assert out == {0: [1.0], 1: [1.0], 2: [1.0], 3: None, 4: None, 5: [1.0]}
    assert spark.range(1).select(stable_hash(F.lit(None))).first()[0].startswith("e3b0c442")


def test_overlapping_runs_leave_one_row_a_key(spark, tmp_path):
    path = str(tmp_path / "cache")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "b", "a", "c"])], "id int, text string")
    value = lambda x: lambda texts: texts.withColumn("embedding", F.array(F.lit(x)))

    def while_another_runs(texts):
        E.fill(df.where("text <> 'c'"), "text", path, E.EMBEDDINGS, value(1.0))  # starts later, writes first
        return value(2.0)(texts)

    got = E.enrich(df, "text", path, E.EMBEDDINGS, while_another_runs)
    assert sorted(r["id"] for r in got.collect()) == [0, 1, 2, 3]
    stored = E.cached(spark, path, E.EMBEDDINGS).collect()
    assert sorted(r["key"] for r in stored) == sorted({r["key"] for r in stored}) and len(stored) == 3
    assert {r["embedding"][0] for r in got.collect()} == {2.0}  # of the newest write
    other = E.enrich(df, "text", path, E.EMBEDDINGS, value(9.0), "2")  # another version of the encoder
    assert {r["embedding"][0] for r in other.collect()} == {9.0} and other.count() == 4
    assert {r["embedding"][0] for r in E.enrich(df, "text", path, E.EMBEDDINGS, value(5.0)).collect()} == {2.0}


def test_relevance_falls_back_by_row(spark):
    rows = [(1, "acme wins", "acme. power"), (2, "acme lost", "acme. power"), (3, "", "acme. power"), (4, "acme wins", "")]
    df = spark.createDataFrame(rows, "id int, Scoring_Text string, Profile string")
    vectors = spark.createDataFrame([("acme wins", [1.0, 0.0]), ("acme. power", [0.6, 0.8])], "t string, embedding array<double>")
    vectors = vectors.select(stable_hash(F.col("t")).alias("key"), "embedding")
    got = {r["id"]: r["Article_Relevance"] for r in J.relevance(df, vectors).collect()}
    assert got == {1: pytest.approx(0.8), 2: pytest.approx(1 / 3), 3: 0.0, 4: 0.0}
    assert {r["id"]: r["Article_Relevance"] for r in J.relevance(df, None).collect()}[1] == pytest.approx(1 / 3)


def test_sentiment_columns_equal_the_batch_scorer(spark):
    texts = ["the profit", "fined and FINED, wins", "", None, "growth-growth 3loss"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    columns = ["text", "Sentiment_Positive", "Sentiment_Neutral", "Sentiment_Negative", "Sentiment_Score"]
    rows = lambda out: sorted(map(tuple, out.select(columns).collect()), key=str)
    assert rows(E.word_list_sentiment(df, "text")) == rows(E.score_sentiment(df, "text", E.word_list_scorer))


def test_hashed_embedding_is_a_unit_count_vector(spark):
    texts = ["b a b", "A, b", "", "b a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    vec = {r["i"]: np.array(r["embedding"]) for r in E.hashed_embedding(df, "text", 1024).collect()}
    assert np.allclose(vec[0], vec[1]) and np.allclose(vec[0], vec[3])  # sets of the same words
    assert np.linalg.norm(vec[0]) == pytest.approx(1.0) and np.count_nonzero(vec[0]) == 2
    assert not vec[2].any()


def test_failing_texts_are_neutral_and_marked(spark):
    df = spark.createDataFrame([("the profit",), ("fined and fined",), (None,)], "text string")
    pick = lambda rows: [tuple(r)[1:] for r in rows]
    good = pick(E.score_sentiment(df, "text", E.word_list_scorer).collect())
    assert good[0] == (2 / 3, 1 / 3, 0.0, 2 / 3, False) and good[1][3] == pytest.approx(-0.75) and good[2] == (0.0, 1.0, 0.0, 0.0, False)

    def broken(texts: pd.Series) -> pd.DataFrame:
        if texts.str.contains("fined").any():
            raise RuntimeError("no model")
        return E.word_list_scorer(texts)

    got = pick(E.score_sentiment(df.coalesce(1), "text", broken).collect())
    assert got == [good[0], (0.0, 1.0, 0.0, 0.0, True), good[2]]


@pytest.mark.parametrize("rows_at_once", ["7", "1000"])
def test_failures_do_not_depend_on_batches(spark, rows_at_once):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def picky(texts: pd.Series) -> pd.DataFrame:
        if texts.str.endswith("3").any():
            raise RuntimeError("a three")
        return E.word_list_scorer(texts)

    try:
        spark.conf.set(key, rows_at_once)
        df = spark.range(100).select(F.concat(F.lit("profit "), "id").alias("text"))
        got = {r["text"]: r["Sentiment_Failed"] for r in E.score_sentiment(df, "text", picky).collect()}
    finally:
        spark.conf.set(key, before)
    assert got == {f"profit {i}": i % 10 == 3 for i in range(100)}


def test_a_repeated_run_leaves_no_stale_day(spark, tmp_path):
    schema = T.StructType([T.StructField("News_Date", T.DateType()), T.StructField("x", T.LongType())])
    path = str(tmp_path / "t")
    day = lambda i: dt.date(2024, 1, i)
    put = lambda rows, span: ST.replace_range(spark.createDataFrame(rows, schema), path, schema, *span)
    put([(day(1), 1), (day(2), 2), (day(3), 3)], (day(1), day(3)))
    put([(day(2), 20)], (day(2), day(3)))  # the third day has no rows now
    assert sorted(map(tuple, ST.read_range_table(spark, path, schema).collect())) == [(day(1), 1), (day(2), 20)]
    assert sorted(map(tuple, ST.read_range_table(spark, path, schema, back=1).collect())) == [(day(1), 1), (day(2), 2), (day(3), 3)]
    put([], (day(1), day(3)))
    assert ST.read_range_table(spark, path, schema).count() == 0


RANGE = T.StructType([T.StructField("News_Date", T.DateType()), T.StructField("x", T.LongType())])


def test_many_writes_leave_one_scan_and_snapshots(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "SNAPSHOT_EVERY", 4)
    path, rng = str(tmp_path / "t"), random.Random(2)
    day = lambda i: dt.date(2024, 1, 1 + i)
    states, now = [{}], {}
    for version in range(1, 11):
        a, b = sorted(rng.choices(range(12), k=2))
        rows = [(day(i), 100 * version + i) for i in range(a, b + 1) if rng.random() < 0.7]
        assert ST.replace_range(spark.createDataFrame(rows, RANGE), path, RANGE, day(a), day(b)) == len(rows)
        now = {d: x for d, x in now.items() if not day(a) <= d <= day(b)} | dict(rows)
        states.append(now)
    assert ST._numbers(spark, f"{path}/_snapshot", "version=") == [4, 8]
    for back in range(11):
        assert dict(map(tuple, ST.read_range_table(spark, path, RANGE, back=back).collect())) == states[10 - back]
    some = ST.read_range_table(spark, path, RANGE, start=day(2), end=day(5))
    assert dict(map(tuple, some.collect())) == {d: x for d, x in now.items() if day(2) <= d <= day(5)}
    plan = ST.read_range_table(spark, path, RANGE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_two_writers_cannot_take_one_version(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "t")
    with ThreadPoolExecutor(8) as pool:
        taken = list(pool.map(lambda _: ST.claim_version(spark, path), range(24)))
    assert sorted(taken) == list(range(1, 25))


def test_a_writer_passed_by_a_snapshot_publishes_anew(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "SNAPSHOT_EVERY", 2)
    path, day = str(tmp_path / "t"), dt.date(2024, 1, 1)
    put = lambda x: ST.replace_range(spark.createDataFrame([(day, x)], RANGE), path, RANGE, day, day)
    slow = ST.claim_version(spark, path)  # claims, and does not get to the log before others
    for x in (2, 3, 4):
        put(x)
    assert slow == 1 and ST._numbers(spark, f"{path}/_snapshot", "version=") == [4]
    monkeypatch.setattr(ST, "claim_version", lambda *_, real=ST.claim_version, first=[slow]: first.pop() if first else real(spark, path))
    put(1)
    assert ST.read_range_table(spark, path, RANGE).collect() == [(day, 1)]


def test_lookback_counts_rows_not_days(spark):
    from presspulse.operators import features as FE

    days = [dt.date(2023, 1, 2) + dt.timedelta(days=i) for i in range(400)]
    rng = np.random.default_rng(1)
    rows = [("DENSE", d, *rng.uniform(90, 110, 5).tolist()) for d in days] + [("SPARSE", d, *rng.uniform(90, 110, 5).tolist()) for d in days[::31]]
    rows += [("NEW", d, 1.0, 2.0, 3.0, 4.0, 5.0) for d in days[-2:]]
    daily = spark.createDataFrame(rows, "Ticker string, News_Date date, Open double, High double, Low double, Close double, Volume double")
    daily = daily.withColumns({c: F.lit(0.1) for c in ("Sentiment_Score", *C.TOPIC_COLUMNS)})
    companies = daily.select(F.col("Ticker").alias("ticker")).distinct()
    start = days[-40]

    def made(history):
        features = FE.engineered(history, FE.ticker_codes(companies))
        return FE.sequences(features, C.ENGINEERED_COLUMNS).where(F.col("News_Date") >= F.lit(start))

    few = FE.with_lookback(daily, start)
    assert few.where("Ticker = 'DENSE'").count() == 40 + FE.LOOKBACK_ROWS and few.where("Ticker = 'SPARSE'").count() == len(days[::31])
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, made(few).collect()), key=key) == sorted(map(tuple, made(daily).collect()), key=key)


def test_incremental_ingest_equals_one_load(spark, tmp_path):
    rng = random.Random(11)
    schema = "ord long, Ticker string, Headline string, URL string, Published_At timestamp_ntz"
    start = dt.datetime(2024, 1, 8)
    rows = [
        (i, f"T{rng.randint(0, 1)}", f"News {rng.randint(0, 12)}", f"http://e.com/{rng.randint(0, 12)}",
         start + dt.timedelta(hours=rng.uniform(0, 96)))
        for i in range(120)
    ]
    rng.shuffle(rows)  # late files: the feed order is not the order of arrival
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (rows[:50], rows[50:90], rows[90:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        table = ingest_articles(stream, lambda batch: batch, root, ())
    again = ingest_articles(spark.readStream.schema(schema).parquet(source), lambda batch: batch, root, ())
    from presspulse.functions.market_time import news_date

    whole = N.duplicate_keys(spark.createDataFrame(rows, schema).withColumn("News_Date", news_date(F.col("Published_At"), ())))
    want = sorted(r["ord"] for r in N.dedupe(whole.where("News_Date IS NOT NULL"), DAY, "ord").collect())
    assert sorted(r["ord"] for r in table.collect()) == sorted(r["ord"] for r in again.collect()) == want


def test_a_batch_reads_itself_and_the_state(spark, tmp_path):
    root = tmp_path / "out"
    at = dt.datetime(2024, 1, 9, 12)
    batch = lambda *rows: spark.createDataFrame([(o, "T", h, u, at + dt.timedelta(days=d)) for o, h, u, d in rows], "ord long, Ticker string, Headline string, URL string, Published_At timestamp_ntz")
    url = "http://e.com/{}".format
    first = batch((5, "five", url(1), 0), (6, "six", url(1), 0), (7, "seven", url(2), 1))
    late = batch((1, "five", url(9), 0), (6, "six again", url(1), 0))  # 1 takes 5's headline, so 6 is no copy any more
    got = lambda: sorted((r["ord"], r["Headline"]) for r in surviving_articles(spark, str(root), first.schema).collect())
    ingest_batch(first, 0, str(root), ())
    assert got() == [(5, "five"), (7, "seven")]
    ingest_batch(first, 0, str(root), ())  # run again
    assert got() == [(5, "five"), (7, "seven")]
    (root / "arrived" / "batch=0").rename(tmp_path / "away")
    ingest_batch(late, 1, str(root), ())
    (tmp_path / "away").rename(root / "arrived" / "batch=0")
    assert got() == [(1, "five"), (6, "six"), (7, "seven")]
    ingest_batch(late.limit(0), 2, str(root), ())
    ingest_batch(late, 1, str(root), ())
    assert got() == [(1, "five"), (6, "six"), (7, "seven")]


def test_listed_days_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda n: dt.date(2025, 1, n)
    rows = lambda *r: spark.createDataFrame(r, "News_Date date, k string, v double")
    assert ST.replace_range(rows((day(1), "a", 1.0), (day(2), "b", 2.0), (day(3), "c", 3.0)), path, TABLE, day(1), day(3)) == 3
    assert ST.replace_listed(rows((day(1), "x", 1.0), (day(3), "y", 1.0)), path, TABLE) == 2
    assert ST.replace_listed(rows((day(1), "x", 1.0)).limit(0), path, TABLE) == 0
    assert {r["k"] for r in ST.read_range_table(spark, path, TABLE).collect()} == {"x", "b", "y"}
    assert {r["k"] for r in ST.read_range_table(spark, path, TABLE, days={day(2), day(9)}).collect()} == {"b"}
    assert {r["k"] for r in ST.read_range_table(spark, path, TABLE, back=1).collect()} == {"a", "b", "c"}


def test_whole_rows_are_not_checkpointed_by_ingest(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, "T", f"News {i % 50}", f"http://e.com/{i}", dt.datetime(2025, 1, 8, 12), rng.randbytes(20_000).hex()) for i in range(100)]
    batch = spark.createDataFrame(rows, "ord long, Ticker string, Headline string, URL string, Published_At timestamp_ntz, Description string")
    size = lambda: sum(f.stat().st_size for f in Path(urlparse(ST.shared_dir(spark)).path).rglob("*") if f.is_file())
    before = size()
    ingest_batch(batch, 0, str(tmp_path / "out"), ())
    assert size() - before < 1_000_000  # the texts have 4,000,000 characters
    kept = surviving_articles(spark, str(tmp_path / "out"), batch.schema)
    assert {r["ord"]: r["Description"] for r in kept.collect()} == {r[0]: r[5] for r in rows[:50]}


@pytest.mark.parametrize("most", [0, 60, 500])
def test_ingest_stores_every_row_once_whatever_is_broadcast(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(ingest, "MAX_BROADCAST_KEYS", most)
    rows = [(i, "T", f"News {i % 50}", f"http://e.com/{i}", dt.datetime(2025, 1, 8, 12)) for i in range(200)]
    batch = spark.createDataFrame(rows, "ord long, Ticker string, Headline string, URL string, Published_At timestamp_ntz")
    ingest_batch(batch, 0, str(tmp_path), ())
    stored = spark.read.parquet(str(tmp_path / "arrived"))
    assert sorted((r["ord"], r["stored"] == "true") for r in stored.collect()) == [(i, i < 50) for i in range(200)]
