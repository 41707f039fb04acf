from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.operators import daily as D
from presspulse.operators import market as MK
from presspulse.plans import jobs as J
from presspulse.schemas import DAILY, conform

DAY = dt.date(2025, 8, 13)
T1, T2 = C.TOPIC_COLUMNS[:2]


def articles(spark, rows):
    """rows: (ord, headline, weight, score, pos, neu, neg, index of the sure topic)"""
    data = [
        ("T", DAY, o, h, float(w), s, p, u, n, *[1.0 if i == k else 0.0 for i in range(6)]) for o, h, w, s, p, u, n, k in rows
    ]
    cols = ", ".join(f"{c} double" for c in C.TOPIC_COLUMNS)
    return spark.createDataFrame(
        data,
        "Ticker string, News_Date date, ord int, Headline string, w double, Sentiment_Score double, "
        f"Sentiment_Positive double, Sentiment_Neutral double, Sentiment_Negative double, {cols}",
    )


def test_weighted_day(spark):
    df = articles(spark, [(2, "B", 0.3, -0.4, 0.1, 0.2, 0.7, 0), (1, "A", 0.7, 0.8, 0.9, 0.05, 0.05, 1), (3, None, 0.0, 0.0, 0.0, 0.0, 0.0, 0)])
    row = D.fill_empty_days(D.aggregate_day(df, "ord", "w")).first()
    assert row["Sentiment_Score"] == pytest.approx(0.7 * 0.8 - 0.3 * 0.4)
    assert row["Predicted_Topic"] == T2  # the weights decide, not the number of votes
    assert row["Headlines"] == "A || B || "
    assert row["Article_Count"] == 3


def test_missing_scores_are_skipped(spark):
    df = articles(spark, [(1, "A", 0.5, None, 1.0, 0.0, 0.0, 0), (2, "B", 0.5, float("nan"), 1.0, 0.0, 0.0, 0)])
    assert D.aggregate_day(df, "ord", "w").first()["Sentiment_Score"] == 0.0


def test_unnormalized_aggregate_equals_normalizing_first(spark):
    rng = random.Random(5)
    df = articles(spark, [(i, "h", rng.choice([0, 1, 2, 3]), rng.uniform(-1, 1), 0.2, 0.3, 0.5, i % 6) for i in range(50)])
    shares = D.normalize_weights(df, "w", "share").drop("w")
    two_step = D.aggregate_day(shares, "ord", "share").first()
    one_step = D.aggregate_unnormalized(df, "w").first()
    for c in D.WEIGHTED:
        assert one_step[c] == pytest.approx(two_step[c], abs=1e-12)
    zero = D.aggregate_unnormalized(df.withColumn("w", F.lit(0.0)), "w").first()
    assert zero["Sentiment_Negative"] == pytest.approx(0.5)


def test_weight_shares_sum_to_one_and_fall_back_to_uniform(spark):
    rows = [("A", DAY, w) for w in (0.2, 0.3, 0.5)] + [("B", DAY, 0.0)] * 4
    df = spark.createDataFrame(rows, "Ticker string, News_Date date, w double")
    got = D.normalize_weights(df, "w", "share").groupBy("Ticker").agg(F.sum("share"), F.min("share"), F.count("share")).collect()
    assert sorted((t, pytest.approx(s), pytest.approx(m), n) for t, s, m, n in got) == [("A", 1.0, 0.2, 3), ("B", 1.0, 0.25, 4)]


def valid(**changes):
    row = {
        "Ticker": "T", "Sentiment_Positive": 0.3, "Sentiment_Neutral": 0.4, "Sentiment_Negative": 0.3, "Sentiment_Score": 0.0,
        "Open": 100.0, "High": 105.0, "Low": 99.0, "Close": 102.0, **dict.fromkeys(C.TOPIC_COLUMNS, 1 / 6),
    }
    return {**row, **changes}


@pytest.mark.parametrize(
    "changes, want",
    [
        ({}, []),
        ({"Ticker": " "}, ["Ticker is missing or blank"]),
        ({"Ticker": None}, ["Ticker is missing or blank"]),
        ({T1: 0.9}, ["Topic probabilities sum to 1.7333, expected ~1.0"]),
        ({T1: None}, ["Topic probabilities sum to 0.8333, expected ~1.0"]),
        ({"Sentiment_Positive": 0.9}, ["Sentiment probabilities sum to 1.6000, expected ~1.0"]),
        ({"Sentiment_Neutral": None}, ["Sentiment probability columns are missing"]),
        ({"Sentiment_Score": 5.0}, ["Sentiment_Score 5.0 is out of range [-1, 1]"]),
        ({"Sentiment_Score": None}, ["Sentiment_Score is missing"]),
        ({"Close": None, "Low": float("nan")}, ["Low is missing", "Close is missing"]),
    ],
)
def test_validation(spark, changes, want):
    schema = ", ".join(f"{k} {'string' if k == 'Ticker' else 'double'}" for k in valid())
    df = spark.createDataFrame([tuple(valid(**changes).values())], schema)
    assert df.select(D.problems()).first()[0] == want
    good, held = D.split_valid(df)
    assert (good.count(), held.count()) == ((1, 0) if not want else (0, 1))


def bars(spark, tickers=("A", "B"), n=60, start=dt.date(2025, 5, 1)):
    rng = random.Random(0)
    rows = []
    for t in tickers:
        price = 100.0
        for i in range(n):
            price *= 1 + rng.uniform(-0.02, 0.02)
            rows.append((t, start + dt.timedelta(days=i), price, price + 2, price - 2, price + 1, 1000.0 + i))
    return MK.normalize_bars(spark.createDataFrame(rows, "Ticker string, Date date, Open double, High double, Low double, Close double, Volume double"))


def test_daily_job_gives_every_company_a_row_and_never_looks_ahead(spark):
    history = bars(spark)
    companies = spark.createDataFrame([("A", "Alpha"), ("B", "Beta"), ("C", "Gamma")], "ticker string, name string")
    start, end = dt.date(2025, 6, 2), dt.date(2025, 6, 6)
    scored = articles(spark, [(1, "Up", 1.0, 0.6, 0.7, 0.2, 0.1, 4)]).withColumns(
        {"Ticker": F.lit("A"), "News_Date": F.lit(start)}
    ).withColumnRenamed("w", "News_Impact_Weight")
    days = J.company_days(companies, start, end, ("2025-06-04",))
    daily = J.build_daily(scored, days, history)
    assert daily.schema.fieldNames() == DAILY.fieldNames()
    rows = {(r["Ticker"], r["News_Date"]): r for r in daily.collect()}
    assert len(rows) == 3 * 4
    with_news, without = rows["A", start], rows["B", start]
    assert (with_news["Sentiment_Score"], with_news["Sentiment_Label"], with_news["Headlines"]) == (0.6, "Positive", "Up")
    assert (without["Sentiment_Neutral"], without["Sentiment_Label"], without["Article_Count"]) == (1.0, "Neutral", 0)
    assert without["Predicted_Topic"] == T1
    closes = {(r["Ticker"], r["Date"]): r["Close"] for r in history.collect()}
    assert all(rows[t, d]["Close"] == closes[t, d] for t, d in rows if t != "C")
    assert rows["C", start]["Close"] is None and rows["C", start]["Volatility"] is None
    cut = J.build_daily(scored, days, history.where("Date <= DATE'2025-06-03'"))
    same = {(r["Ticker"], r["News_Date"]): r for r in cut.collect()}
    assert same["A", dt.date(2025, 6, 3)]["Volatility"] == rows["A", dt.date(2025, 6, 3)]["Volatility"]
    atr = J.build_daily(scored, days, history, measure="atr").where("Ticker = 'A'").first()
    assert atr["Volatility"] > 0 and atr["Volatility"] != with_news["Volatility"]


def test_conform_orders_adds_and_drops(spark):
    df = conform(spark.createDataFrame([(1, "T")], "extra int, ticker string"), DAILY)
    assert df.columns == DAILY.fieldNames() and df.first()["Ticker"] == "T" and df.first()["Open"] is None
