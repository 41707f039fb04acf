from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presspulse import config as C
from presspulse.plans import run as RUN
from presspulse.schemas import ARTICLES, DAILY, PERFORMANCE, PREDICTIONS
from presspulse.sources import storage as ST

START = dt.date(2025, 8, 11)  # a Monday


def feed_lines():
    """Three days of feeds of two companies: mentions, duplicates, strangers and broken dates."""
    lines, n = [], 0

    def add(ticker, title, url, when, publisher="Reuters"):
        nonlocal n
        n += 1
        lines.append({"Ticker": ticker, "ord": n, "title": title, "description": "Shares and profit in focus", "url": url,
                      "published date": when.strftime("%a, %d %b %Y %H:%M:%S GMT") if when else "yesterday",
                      "publisher": {"title": publisher}})

    for d in range(3):
        at = dt.datetime.combine(START + dt.timedelta(days=d), dt.time(1, 0))  # 06:30 in India
        add("NTPC.NS", f"NTPC wins major order {d}", f"https://e.com/{d}?utm_source=a", at)
        add("NTPC.NS", f"NTPC story {d}", f"http://www.e.com/{d}/", at)  # same link
        add("NTPC.NS", f"NTPC  WINS major order, {d}", f"https://f.com/{d}", at)  # same headline
        add("NTPC.NS", "Another company", f"https://g.com/{d}", at)  # no mention
        add("GAIL.NS", f"GAIL results {d}", f"https://h.com/{d}", at, None)
        add("GAIL.NS", f"GAIL undated {d}", f"https://i.com/{d}", None)
    return lines


@pytest.fixture
def tables(spark, tmp_path):
    feed = tmp_path / "feed.json"
    feed.write_text("\n".join(json.dumps(x) for x in feed_lines()))
    bars = [
        (t, START + dt.timedelta(days=i), p + i, p + i + 2, p + i - 2, p + i + 1, p + i + 1, 1000.0)
        for t, p in (("NTPC.NS", 300.0), ("GAIL.NS", 180.0)) for i in range(-120, 3)
    ]
    from presspulse.schemas import OHLCV

    spark.createDataFrame(bars, OHLCV).write.parquet(str(tmp_path / "bars"))
    return str(feed), str(tmp_path / "bars"), str(tmp_path / "out")


PRICES = [
    (C.ModelSpec("naive", "Close", "formula", "stock_news_v1"), lambda df: F.col("News_Day_Close") * 1.01),
    (C.ModelSpec("absurd", "Open", "formula", "stock_news_v1", unverified=True), lambda df: F.col("Log_Volume")),
    (C.ModelSpec("broken", "Open", "formula", "stock_news_v1"), lambda df: F.lit(None)),
]


def test_run_then_repeat_then_monitor(spark, tables):
    feed_path, bars_path, root = tables
    feed = spark.read.schema("Ticker string, ord long, title string, description string, url string, `published date` string, publisher struct<title: string>").json(feed_path)
    bars = spark.read.parquet(bars_path)
    companies = RUN.company_table(spark)
    go = lambda **kw: {
        r["News_Date"]: (r["Articles"], r["Daily_Rows"], r["Quarantined"], r["Predictions"])
        for r in RUN.run(feed, bars, companies, root, plugins=RUN.Plugins(prices=PRICES), holidays=(), **kw).collect()
    }
    days = [START + dt.timedelta(days=i) for i in range(3)]
    want = (2, 2, 18, 4)  # two companies have bars; one model of three gives nothing
    assert go(start=days[0], end=days[0]) == {days[0]: want}
    assert go() == dict.fromkeys(days, want)
    assert go() == dict.fromkeys(days, want)

    articles = ST.read_range_table(spark, f"{root}/articles", T.StructType([*ARTICLES.fields]).add("ord", "long")).where(F.col("News_Date") == days[0].isoformat()).collect()
    assert {r["Headline"] for r in articles} == {"NTPC wins major order 0", "GAIL results 0"}
    assert {r["Source"] for r in articles} == {"Reuters", "h.com"}
    assert all(r["News_Impact_Weight"] == pytest.approx(1.0) for r in articles)
    daily = ST.read_range_table(spark, f"{root}/daily", DAILY).where("Ticker = 'NTPC.NS'").orderBy("News_Date").collect()
    assert [r["Close"] for r in daily] == [301.0, 302.0, 303.0] and all(r["Volatility"] > 0 for r in daily)
    held = ST.read_range_table(spark, f"{root}/quarantine", T.StructType([*DAILY.fields]).add("problems", "string")).select("problems").distinct().collect()
    assert [r[0] for r in held] == ["Open is missing; High is missing; Low is missing; Close is missing"]

    predictions = ST.read_range_table(spark, f"{root}/predictions", PREDICTIONS).where("Model_Name = 'absurd'").collect()
    assert all(r["Predicted_Value"] == pytest.approx(0.8 * r["Last_Close"]) and r["Unverified"] for r in predictions)
    measured, alerts = RUN.monitor(spark, root, horizon=1)
    assert measured.columns == PERFORMANCE.fieldNames()
    assert {(r["Ticker"], r["Model_Name"], r["N_Samples"]) for r in measured.collect()} == {
        (t, m, 2) for t in ("NTPC.NS", "GAIL.NS") for m in ("naive", "absurd")
    }
    assert {r["Model_Name"] for r in alerts.collect()} == {"absurd"}
    assert spark.read.parquet(f"{root}/alerts").count() == alerts.count() > 0
    RUN.monitor(spark, root)
    assert spark.read.parquet(f"{root}/performance").count() == 8


def test_an_empty_feed_still_gives_every_company_a_row(spark, tables):
    _, bars_path, root = tables
    schema = "Ticker string, ord long, title string, description string, url string, `published date` string, publisher struct<title: string>"
    empty = spark.createDataFrame([], schema)
    bars = spark.read.parquet(bars_path)
    with pytest.raises(ValueError):
        RUN.run(empty, bars, RUN.company_table(spark), root)
    stats = RUN.run(empty, bars, RUN.company_table(spark), root, START, START, holidays=()).first()
    assert (stats["Articles"], stats["Daily_Rows"], stats["Quarantined"]) == (0, 2, 18)
    assert ST.read_range_table(spark, f"{root}/daily", DAILY).select("Sentiment_Neutral").first()[0] == 1.0


def test_bars_that_come_late_leave_no_quarantined_row(spark, tables):
    feed_path, bars_path, root = tables
    feed = spark.read.schema("Ticker string, ord long, title string, description string, url string, `published date` string, publisher struct<title: string>").json(feed_path)
    bars = spark.read.parquet(bars_path)
    go = lambda f, b: RUN.run(f, b, RUN.company_table(spark), root, START, START, holidays=()).first()
    assert (go(feed, bars.limit(0))["Daily_Rows"], go(feed, bars)["Daily_Rows"]) == (0, 2)
    last = go(feed.where("Ticker = 'GAIL.NS'"), bars)
    assert (last["Articles"], last["Daily_Rows"], last["Quarantined"]) == (1, 2, 18)


def test_a_day_of_many_articles_is_kept_whole(spark):
    from presspulse.plans import jobs as J
    from presspulse.plans.inputs import with_scores

    at = dt.datetime.combine(START + dt.timedelta(days=1), dt.time(6, 0))
    rows = [(i, "NTPC.NS", "NTPC", at, f"NTPC story number {i}", "d", "Reuters", f"https://e.com/{i % 450}") for i in range(500)]
    feed = spark.createDataFrame(rows, "ord long, Ticker string, Company string, Published_At timestamp_ntz, Headline string, Description string, Publisher string, URL string")
    chosen = J.select_articles(feed, RUN.company_table(spark), ())
    assert sorted(r["ord"] for r in chosen.select("ord").collect()) == list(range(450))
    scored = J.score_articles(with_scores(chosen))
    assert scored.agg(F.sum("News_Impact_Weight")).first()[0] == pytest.approx(1.0)


def stored_pairs(spark, root, first, n, price, tickers=("A", "B")):
    """Store predictions and daily rows of ``n`` days; ticker B has every third day only."""
    days = [(t, START + dt.timedelta(days=i)) for i in range(first, first + n) for t in tickers if t == "A" or i % 3 == 0]
    daily = [{"Ticker": t, "News_Date": d, "Open": price + d.day, "Close": price - d.day} for t, d in days]
    made = [
        {"Ticker": t, "News_Date": d, "Model_Name": m, "Target": g, "Predicted_Value": price + d.day * x, "Last_Close": price}
        for t, d in days for m, x in (("m", 2.0), ("k", -1.0)) for g in ("Open", "Close")
    ]
    end = START + dt.timedelta(days=first + n - 1)
    for name, rows, schema in (("daily", daily, DAILY), ("predictions", made, PREDICTIONS)):
        df = spark.createDataFrame([[r.get(f) for f in schema.fieldNames()] for r in rows], schema)
        ST.replace_range(df, f"{root}/{name}", schema, START + dt.timedelta(days=first), end)


@pytest.mark.parametrize("horizon", [0, 1])
def test_accuracy_of_changed_days_is_accuracy_from_scratch(spark, tmp_path, horizon):
    from presspulse.plans import jobs as J
    root = str(tmp_path / "r")

    def both():
        found, _ = RUN.monitor(spark, root, horizon)
        fresh = J.monitor(ST.read_range_table(spark, f"{root}/predictions", PREDICTIONS), ST.read_range_table(spark, f"{root}/daily", DAILY), horizon)
        names = [c for c in PERFORMANCE.fieldNames() if c != "Evaluated_At"]
        got, want = (sorted(tuple(r) for r in df.select(names).collect()) for df in (found, fresh))
        assert len(got) == len(want) > 0
        for g, w in zip(got, want, strict=True):
            assert g[:4] == w[:4] and g[4:] == pytest.approx(w[4:])

    stored_pairs(spark, root, 0, 9, 100.0)
    both()
    rows = spark.read.parquet(f"{root}/performance").count()
    RUN.monitor(spark, root, horizon)
    assert spark.read.parquet(f"{root}/performance").count() == rows  # nothing new, nothing repeated
    stored_pairs(spark, root, 9, 1, 110.0)
    stored_pairs(spark, root, 6, 1, 90.0, tickers=("A",))  # replaced in the middle; a row of the sparse ticker goes
    both()
    assert spark.read.parquet(f"{root}/performance").count() > rows


def test_models_are_trained_stored_and_used(spark, tables):
    from presspulse.operators import regression as RG

    feed_path, bars_path, root = tables
    feed = spark.read.schema("Ticker string, ord long, title string, description string, url string, `published date` string, publisher struct<title: string>").json(feed_path)
    bars, companies = spark.read.parquet(bars_path), RUN.company_table(spark)
    with pytest.raises(ValueError, match="no stored model"):
        RG.stored_models(spark, f"{root}/models", ["price"])
    RUN.run(feed, bars, companies, root, holidays=())
    assert [RUN.train(spark, root, companies, "price", ["Open", "Close"]) for _ in range(2)] == [1, 2]
    prices = RG.stored_models(spark, f"{root}/models", ["price"])
    assert [(m.name, m.target, m.feature_set) for m, _ in prices] == [("price", t, "version 2") for t in ("Close", "Open")]
    counts = RUN.run(feed, bars, companies, root, holidays=(), plugins=RUN.Plugins(prices=prices)).collect()
    assert [r["Predictions"] for r in counts] == [4, 4, 4]
    made = ST.read_range_table(spark, f"{root}/predictions", PREDICTIONS).where("Target = 'Close'").collect()
    # bars rise by one a day, so the line is exact: the next close is this one plus 1
    assert all(r["Raw_Predicted_Value"] == pytest.approx(r["Last_Close"] + 1) for r in made)


def test_pages_stand_in_for_missing_descriptions(spark, tables):
    _, bars_path, root = tables
    row = lambda n, described, page: (f"NTPC wins order {n}", described, f"https://e.com/{n}", "Mon, 11 Aug 2025 01:00:00 GMT", None, "NTPC.NS", n, page)
    body = "Record profit &amp; growth &#8211; " + "strong results " * 40
    feed = spark.createDataFrame(
        [row(1, "told", f"<p>{body}</p>"), row(2, "", f"<html><p>{body}</p></html>"), row(3, None, None)],
        "title string, description string, url string, `published date` string, publisher struct<title: string>, Ticker string, ord long, Html string",
    )
    RUN.run(feed, spark.read.parquet(bars_path), RUN.company_table(spark), root, START, START, holidays=())
    got = {r["Headline"][-1]: r for r in ST.read_range_table(spark, f"{root}/articles", ARTICLES).collect()}
    assert [got[n]["Summary"] for n in "13"] == ["told", ""]
    assert got["2"]["Summary"].startswith("Record profit & growth – strong results")
    assert got["2"]["Sentiment_Score"] > got["3"]["Sentiment_Score"]  # the page is scored, too
