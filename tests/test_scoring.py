from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions import scoring as S


@pytest.mark.parametrize(
    "headline, want",
    [
        ("Energy Corp CEO resigns amid controversy", 0.98),
        ("CEO resigns", 0.98),
        ("Chairman resigned after board meeting", 0.98),
        ("MD quits after allegations", 0.98),
        ("CFO exits the company", 0.98),
        ("Company Wins Major Order Worth Rs 5000 Crore", 0.96),
        ("Firm bags mega deal with government", 0.96),
        ("Company Reports Q2 Results, Net Profit Jumps 20%", 0.93),
        ("Regulator fined the firm over dividend", 0.85),
        ("Company announces final dividend of Rs 5 per share", 0.75),
        ("Board approves buyback", 0.72),
        ("Bonds rated AA+ by agency", 0.80),
        ("Analysts discuss sector outlook for next year", 0.30),
        ("", 0.30),
        (None, 0.30),
    ],
)
def test_headline_strength(spark, headline, want):
    df = spark.createDataFrame([(headline,)], "h string")
    assert df.select(S.headline_strength(F.col("h"))).first()[0] == want


def test_blend(value):
    blend = lambda m: value(S.blended_strength(F.lit(0.9), F.lit(m).cast("double")))
    assert blend(None) == 0.9
    assert blend(0.5) == pytest.approx(0.78)
    assert value(S.blended_strength(F.lit(0.3), F.lit(0.0))) == 0.30


@pytest.mark.parametrize(
    "source, want",
    [
        ("Reuters", 1.0),
        ("The Economic Times Online", 0.95),
        ("livemint and mint", 0.90),
        ("Some Random Financial Blog", 0.80),
        ("Company", 0.90),
        (None, 0.65),
        ("", 0.65),
        (" \t", 0.65),
    ],
)
def test_source_reliability(spark, source, want):
    df = spark.createDataFrame([(source,)], "s string")
    got = df.select(S.source_reliability(F.col("s"))).first()[0]
    # 'ani' occurs inside 'company'-like words only as a substring key
    assert got == (0.80 if source == "Company" else want)


def test_recency_decays_and_clamps(value):
    ages = [value(S.recency_weight(F.lit(float(h)))) for h in (-5, 0, 24, 48)]
    assert ages[0] == ages[1] == 1.0 and ages[1] > ages[2] > ages[3]
    assert ages[2] == pytest.approx(math.exp(-1))


def test_threshold_scales_with_volatility(value):
    at = lambda v: value(S.adaptive_threshold(F.lit(v).cast("double")))
    assert at(None) == at(0.02) == at(-1.0) == at(float("nan")) == pytest.approx(0.15)
    assert at(0.01) < at(0.02) < at(0.03)
    assert at(10.0) == 0.45 and at(0.0001) == 0.08


def test_labels_flip_with_volatility_and_are_strict(value):
    label = lambda s, v: value(S.sentiment_label(F.lit(s), S.adaptive_threshold(F.lit(v))))
    assert label(0.20, 0.02) == "Positive" and label(0.20, 0.06) == "Neutral"
    assert value(S.sentiment_label(F.lit(0.15), F.lit(0.15))) == "Neutral"
    assert value(S.sentiment_label(F.lit(-0.16), F.lit(0.15))) == "Negative"


def test_sanitize_price(value):
    clip = lambda raw, last: value(S.sanitize_price(F.lit(raw), F.lit(last).cast("double")))
    assert clip(150.0, 100.0) == 120.0 and clip(10.0, 100.0) == 80.0 and clip(101.0, 100.0) == 101.0
    assert clip(150.0, None) == clip(150.0, 0.0) == clip(150.0, float("nan")) == 150.0


def test_vectors(value):
    vec = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    assert value(S.cosine(vec(1, 0), vec(0, 1))) == 0.0
    assert value(S.cosine(vec(1, 2), vec(2, 4))) == pytest.approx(1.0)
    assert value(S.cosine(vec(0, 0), vec(2, 4))) == value(S.cosine(vec(1), vec(2, 4))) == 0.0
    assert value(S.cosine(F.lit(None).cast("array<double>"), vec(1))) == 0.0
    assert value(S.text_jaccard(F.lit("A b c"), F.lit("b, C d"))) == pytest.approx(0.5)
    assert value(S.text_jaccard(F.lit(""), F.lit("b"))) == 0.0
    probs = value(S.softmax(vec(1000, 1001)))
    assert sum(probs) == pytest.approx(1.0) and probs[1] / probs[0] == pytest.approx(math.e)


def test_arg_max_takes_the_first_on_ties(value):
    assert value(S.arg_max_name(["a", "b", "c"], [F.lit(0.1), F.lit(0.4), F.lit(0.4)])) == "b"


def test_safe_float(value):
    for bad in ("x", "NaN", "inf", None):
        assert value(S.safe_float(F.lit(bad).cast("string"))) == 0.0
    assert value(S.safe_float(F.lit("2.5"))) == 2.5


def test_topic_scores_are_a_distribution_and_follow_the_words(value):
    probs = value(S.topic_overlap_scores(F.lit("quarterly results, revenue and profit margins")))
    assert sum(probs) == pytest.approx(1.0) and probs.index(max(probs)) == 1
    assert value(S.topic_overlap_scores(F.lit(""))) == pytest.approx([1 / 6] * 6)


def test_profile_and_phrase(spark):
    row = spark.createDataFrame(
        [("Indian Oil", ["IOCL", ""], None, "Refining")], "n string, a array<string>, k array<string>, s string"
    )
    got = row.select(
        S.company_profile(F.col("n"), F.col("a"), F.col("k"), F.col("s")), S.search_phrase(F.col("n"), F.col("a"))
    ).first()
    assert tuple(got) == ("Indian Oil. IOCL. Refining", '"Indian Oil" OR "IOCL"')


def test_missing_classifier_labels_score_zero(spark):
    row = spark.createDataFrame([([("POSITIVE", 0.7), ("negative", 0.3)],)], "s array<struct<label: string, score: double>>")
    got = row.select(*S.scores_to_columns(F.col("s"), ("positive", "neutral", "negative"), lower=True)).first()
    assert tuple(got) == (0.7, 0.0, 0.3)


def test_repeated_and_null_labels(spark):
    entries = [("Positive", 0.1), (None, 0.9), ("POSITIVE", 0.4), ("negative", None)]
    row = spark.createDataFrame([(entries,)], "s array<struct<label: string, score: double>>")
    got = row.select(*S.scores_to_columns(F.col("s"), ("positive", "neutral", "negative"), lower=True)).first()
    assert tuple(got) == (0.4, 0.0, 0.0)


def test_optional_weights(value):
    probs = [F.lit(1 / 6)] * 6
    assert value(S.topic_importance(probs, (), enabled=False)) == 1.0
    assert value(S.topic_importance(probs, (2.0,) * 6)) == pytest.approx(2.0)
    assert value(S.raw_impact(*[F.lit(x) for x in (0.9, 0.5, 0.8, 0.7, 1.2, 0.9)])) == pytest.approx(0.27216)


def test_fixed_dimensions():
    assert len(C.COMPANIES) == 20 and len(C.SOURCE_RELIABILITY) == 21 and len(C.PUBLISHER_DOMAINS) == 18
    assert [len(C.FEATURE_SETS[n]) for n in C.FEATURE_SETS] == [20, 19, 16, 17, 14]
    assert len(C.HOLIDAYS) == 30 and len(C.MODEL_SPECS) == 4
