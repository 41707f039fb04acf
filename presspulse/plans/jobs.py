"""The composite jobs: articles -> daily rows -> predictions -> accuracy, for all days at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions import market_time as M
from presspulse.functions import scoring as S
from presspulse.functions.text import clean_text, page_text, scoring_text, stable_hash
from presspulse.operators import daily as D
from presspulse.operators import enrich as E
from presspulse.operators import forecast as FC
from presspulse.operators import market as MK
from presspulse.operators import news as N
from presspulse.operators.matching import match_companies
from presspulse.schemas import ARTICLES, DAILY, PREDICTIONS, conform
from presspulse.sources.storage import MAX_BROADCAST_KEYS, broadcast_if_small, cut_lineage


@dataclass(frozen=True)
class Weighting:
    """Optional factors of the impact weight; both are off by default."""

    importance: dict[str, float] | None = None
    multipliers: Sequence[float] | None = None


def company_weight(ticker: Column, importance: dict[str, float] | None) -> Column:
    if not importance:
        return F.lit(1.0)
    table = F.create_map(*[x for k, v in importance.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(F.try_element_at(table, ticker), F.lit(1.0))


def select_articles(
    feed: DataFrame, companies: DataFrame, holidays: Sequence[str] = tuple(C.HOLIDAYS), order: str = "ord"
) -> DataFrame:
    """Feed rows to the articles of each company day: window, mention check, duplicates. Days have any size.

    The mention check reads the whole texts once and leaves narrow rows of keys. Duplicates are settled
    among those, and the surviving keys, broadcast unless they are many, select the article rows. Each row is an article of the feed of one
    company, its ``Ticker``, and must mention that company.
    """
    dated = feed.withColumn("News_Date", M.news_date(F.col("Published_At"), holidays)).where("News_Date IS NOT NULL")
    dim = cut_lineage(companies.select("ticker", "name", "sector", "keywords", "aliases"))
    text = F.concat(F.coalesce("Headline", F.lit("")), F.lit(" "), F.coalesce("Description", F.lit("")))
    narrow = [*D.DAY, order, "url_key", "headline_key"]
    keyed = N.duplicate_keys(dated).withColumn("__text", text)
    mentioned = match_companies(keyed, dim, narrow, "__text", own="Ticker")
    kept = N.surviving_orders(cut_lineage(mentioned), D.DAY, order)
    profiles = dim.select(F.col("ticker").alias("Ticker"), "sector", "keywords", "aliases")
    kept = broadcast_if_small(kept, MAX_BROADCAST_KEYS)
    return dated.join(kept, [*D.DAY, order], "left_semi").join(broadcast_if_small(profiles), "Ticker")


def summary_text(df: DataFrame) -> Column:
    described = clean_text(F.col("Description"))
    if "Html" not in df.columns:
        return described
    body = page_text(F.col("Html"))
    useful = F.when(F.length(body) >= C.MIN_USEFUL_BODY_LENGTH, body)
    return F.coalesce(F.nullif(described, F.lit("")), useful, F.lit(""))


def with_texts(selected: DataFrame) -> DataFrame:
    """Add what scorers read: the summary (the feed's description or, where that is blank, the text of a stored
    page given in ``Html``), the scoring text made from it, and the profile of the article's company."""
    profile = S.company_profile(F.col("Company"), F.col("aliases"), F.col("keywords"), F.col("sector"))
    df = selected.withColumns({"Summary": summary_text(selected), "Profile": profile})
    return df.withColumn("Scoring_Text", scoring_text(F.col("Headline"), F.col("Summary")))


def article_vectors(articles: DataFrame, cache_path: str, encode: Callable[[DataFrame], DataFrame], encoder: str) -> DataFrame:
    """Vectors by text hash of all scoring texts and company profiles, by way of one versioned cache."""
    texts = articles.select(F.explode(F.array("Scoring_Text", "Profile")).alias("text"))
    E.fill(texts, "text", cache_path, E.EMBEDDINGS, encode, encoder)
    return E.cached(articles.sparkSession, cache_path, E.EMBEDDINGS, encoder)


def relevance(articles: DataFrame, vectors: DataFrame | None) -> DataFrame:
    """Add ``Article_Relevance``: the rescaled cosine of the vectors of text and profile; their lexical overlap
    where either vector is missing; 0 where either text is empty.

    Vectors are joined by text hash; profiles, one a company, are broadcast if few.
    """
    lexical = S.text_jaccard(F.col("Scoring_Text"), F.col("Profile"))
    both = (F.col("Scoring_Text") != "") & (F.col("Profile") != "")
    if vectors is None:
        return articles.withColumn("Article_Relevance", F.when(both, lexical).otherwise(0.0))
    keyed = articles.withColumns({"__text": stable_hash(F.col("Scoring_Text")), "__profile": stable_hash(F.col("Profile"))})
    side = lambda c: vectors.select(F.col("key").alias(f"__{c}"), F.col("embedding").alias(f"__{c}_vector"))
    profiles = side("profile").join(keyed.select("__profile").distinct(), "__profile", "left_semi")
    joined = keyed.join(broadcast_if_small(profiles), "__profile", "left").join(side("text"), "__text", "left")
    known = F.col("__text_vector").isNotNull() & F.col("__profile_vector").isNotNull()
    cosine = (S.cosine(F.col("__text_vector"), F.col("__profile_vector")) + 1) / 2
    value = F.when(~both, 0.0).when(known, cosine).otherwise(lexical)
    return joined.withColumn("Article_Relevance", value).drop("__text", "__profile", "__text_vector", "__profile_vector")


def score_articles(
    selected: DataFrame,
    weighting: Weighting = Weighting(),
    sources: Sequence[tuple[str, float]] = tuple(C.SOURCE_RELIABILITY),
    vectors: DataFrame | None = None,
) -> DataFrame:
    """Add relevance, strength, reliability, recency and the share of the day's impact weight.

    Expects the sentiment and topic probabilities of the plugged-in scorers as columns; ``vectors`` are those
    of ``article_vectors``, without which relevance is lexical.
    """
    topics = [F.col(c) for c in C.TOPIC_COLUMNS]
    df = selected if "Scoring_Text" in selected.columns else with_texts(selected)
    df = relevance(df, vectors).withColumn("Source", N.source_name(F.col("Publisher"), F.col("URL")))
    df = df.withColumns(
        {
            "Predicted_Topic": S.arg_max_name(C.TOPIC_COLUMNS, topics),
            "Headline_Strength": S.headline_strength(F.col("Headline")),
            "Source_Reliability": S.source_reliability(F.col("Source"), sources),
            "Recency_Weight": S.recency_weight(M.hours_between(F.col("Published_At"), M.window_end(F.col("News_Date")))),
            "Company_Weight": company_weight(F.col("Ticker"), weighting.importance),
            "Topic_Weight": S.topic_importance(topics, weighting.multipliers or (), weighting.multipliers is not None),
        }
    )
    raw = S.raw_impact(
        *[F.col(c) for c in (
            "Source_Reliability", "Recency_Weight", "Article_Relevance", "Headline_Strength", "Company_Weight", "Topic_Weight",
        )]
    )
    return D.normalize_weights(df.withColumn("__raw", raw), "__raw", "News_Impact_Weight").drop("__raw", "Profile")


def article_table(scored: DataFrame) -> DataFrame:
    return conform(scored, ARTICLES)


def run_days(feed: DataFrame, holidays: Sequence[str]) -> tuple[date, date] | None:
    """First and last news date of a feed, from one column of it; None for an empty feed."""
    d = M.news_date(F.col("Published_At"), holidays)
    lo, hi = feed.select(d.alias("d")).agg(F.min("d"), F.max("d")).first()
    return (lo, hi) if lo is not None else None


def company_days(companies: DataFrame, start: date, end: date, holidays: Sequence[str]) -> DataFrame:
    """Every company on every trading day of the run, with or without news."""
    days = F.filter(F.sequence(F.lit(start), F.lit(end)), lambda d: M.is_trading_day(d, holidays))
    return companies.select(F.col("ticker").alias("Ticker"), F.col("name").alias("Company"), F.explode(days).alias("News_Date"))


def build_daily(
    scored: DataFrame, days: DataFrame, bars: DataFrame, order: str = "ord", measure: str = "vol",
    window: int = C.VOLATILITY_WINDOW, params: C.ThresholdParams = C.ThresholdParams(),
) -> DataFrame:
    """One labelled row per company and run day, with the bar and volatility known on that day."""
    if measure == "atr":
        hist = MK.add_atr(bars).withColumnRenamed("ATR_Over_Close", "Volatility")
    else:
        hist = MK.add_rolling_volatility(bars, window)
    ohlcv = ["Open", "High", "Low", "Close", "Adj_Close", "Volume"]
    hist = hist.select("Ticker", "Date", F.struct(*ohlcv).alias("Bar"), "Volatility")
    grid = MK.as_of_last(days, hist, ["Ticker"], "News_Date", "Date", ["Bar", "Volatility"])
    grid = grid.select("Ticker", "Company", "News_Date", "Bar.*", "Volatility")
    grid = MK.add_reference_volatility(cut_lineage(grid), "News_Date")
    merged = grid.join(D.aggregate_day(scored, order), list(D.DAY), "left")
    return conform(D.label_days(D.fill_empty_days(merged), params=params), DAILY)


def build_predictions(valid: DataFrame, models: Sequence[tuple[C.ModelSpec, Column]]) -> DataFrame:
    """Long predictions of all models for all valid daily rows."""
    long = FC.predict_long(valid, models, ["Ticker", "Company", "News_Date"])
    return conform(long.withColumn("Predicted_At", F.current_timestamp()), PREDICTIONS)


def monitor(predictions: DataFrame, daily: DataFrame, horizon: int = 0) -> DataFrame:
    """Accuracy per ticker, model and target. ``horizon=0`` compares with the row of the same date;
    ``horizon=1`` with the following session, which is what the predictions are about."""
    actuals = FC.melt_actuals(daily if horizon == 0 else FC.next_session(daily))
    return FC.accuracy(FC.with_actuals(predictions, actuals.where("Actual_Value IS NOT NULL") if horizon else actuals))
