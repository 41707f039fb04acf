"""The recurring jobs over stored tables: the daily run (or a backfill), training, and the accuracy check.

    spark-submit -m presspulse.plans.run run     --feed F --bars B --root R [--start D --end D] [--models A,B | --models all]
    spark-submit -m presspulse.plans.run train   --root R --name N
    spark-submit -m presspulse.plans.run monitor --root R [--horizon 1]
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presspulse import config as C
from presspulse.functions import market_time as M
from presspulse.operators import daily as D
from presspulse.operators import enrich as E
from presspulse.operators import features as FE
from presspulse.operators import forecast as FC
from presspulse.operators import market as MK
from presspulse.operators import news as N
from presspulse.operators import regression as RG
from presspulse.plans import jobs as J
from presspulse.plans import monitoring as MO
from presspulse.schemas import ARTICLES, COMPANIES, DAILY, OHLCV, PERFORMANCE, PREDICTIONS, RAW_ARTICLE, conform
from presspulse.sources import storage as ST

Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Plugins:
    """Replaceable models. Sentiment and topic scorers add their probability columns from
    ``Scoring_Text``; ``encode`` adds ``embedding`` to distinct texts, and ``encoder`` names its version; price models are
    columns over daily rows joined with their features."""

    sentiment: Scorer = E.word_list_sentiment
    topics: Scorer = E.description_topics
    encode: Scorer = lambda texts: E.hashed_embedding(texts, "text")
    encoder: str = E.HASHED_ENCODER
    prices: Sequence[tuple[C.ModelSpec, Callable[[DataFrame], Column]]] = ()


def company_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(C.COMPANIES, COMPANIES)


def run(
    feed: DataFrame,
    bars: DataFrame,
    companies: DataFrame,
    root: str,
    start: date | None = None,
    end: date | None = None,
    plugins: Plugins = Plugins(),
    holidays: Sequence[str] = tuple(C.HOLIDAYS),
    measure: str = "vol",
) -> DataFrame:
    """All trading days from ``start`` to ``end`` (by default those of the feed), into the tables
    under ``root``; returns counts per day. ``feed`` holds the rows of each company's feed in the
    feed's own columns, with ``Ticker`` and the feed order ``ord``.

    Each stage is written and read back before the next one uses it, so no stage is computed twice
    and a lost executor costs no more than its own tasks. The whole range is replaced: repeating a run
    neither duplicates rows nor leaves days of an earlier run that have no rows now.
    """
    spark = feed.sparkSession
    articles = N.scan_feed(feed).withColumnsRenamed({"Summary": "Description"})
    articles = articles.join(
        ST.broadcast_if_small(companies.select(F.col("ticker").alias("Ticker"), F.col("name").alias("Company"))), "Ticker"
    ).withColumn("Publisher", F.col("Source"))
    if start is None or end is None:
        span = J.run_days(articles, holidays)
        if span is None:
            raise ValueError("an empty feed needs start and end dates")
        start, end = start or span[0], end or span[1]
    day = M.news_date(F.col("Published_At"), holidays)
    chosen = J.select_articles(articles.where(day.between(start, end)), companies, holidays)
    chosen = ST.cut_lineage(J.with_texts(chosen))
    vectors = J.article_vectors(chosen, f"{root}/embeddings", plugins.encode, plugins.encoder)
    scored = J.score_articles(plugins.topics(plugins.sentiment(chosen)), vectors=vectors)
    path = {t: f"{root}/{t}" for t in ("articles", "daily", "quarantine", "predictions", "performance")}

    keep_order = T.StructType([*ARTICLES.fields]).add("ord", "long")
    ST.replace_range(scored, path["articles"], keep_order, start, end)
    stored = ST.read_range_table(spark, path["articles"], keep_order, start=start, end=end)

    rows = J.build_daily(stored, J.company_days(companies, start, end, holidays), MK.normalize_bars(bars), measure=measure)
    rows = ST.cut_lineage(rows)
    valid, held = D.split_valid(rows)
    ST.replace_range(valid, path["daily"], DAILY, start, end)
    held_schema = T.StructType([*DAILY.fields]).add("problems", "string")
    ST.replace_range(held.withColumn("problems", F.array_join("problems", "; ")), path["quarantine"], held_schema, start, end)

    if plugins.prices:
        history = FE.with_lookback(ST.read_range_table(spark, path["daily"], DAILY, end=end), start)
        today = price_features(history, companies).where(F.col("News_Date").between(start, end))
        made = J.build_predictions(today, [(s, fn(today)) for s, fn in plugins.prices])
        ST.replace_range(made, path["predictions"], PREDICTIONS, start, end)
    return statistics(spark, root, start, end)


def statistics(spark: SparkSession, root: str, start: date, end: date) -> DataFrame:
    """Counts of the stored rows per day."""
    counted = None
    for table, schema in (("articles", ARTICLES), ("daily", DAILY), ("quarantine", DAILY), ("predictions", PREDICTIONS)):
        rows = ST.read_range_table(spark, f"{root}/{table}", schema, start=start, end=end)
        part = rows.select("News_Date", F.lit(table).alias("table"))
        counted = part if counted is None else counted.unionByName(part)
    names = {"articles": "Articles", "daily": "Daily_Rows", "quarantine": "Quarantined", "predictions": "Predictions"}
    return counted.groupBy("News_Date").agg(*[F.count_if(F.col("table") == t).alias(n) for t, n in names.items()])


def price_features(daily: DataFrame, companies: DataFrame) -> DataFrame:
    """Daily rows with all feature families of the price models."""
    carried = [c for c in DAILY.fieldNames() if c not in ("Ticker", "News_Date", *C.ENGINEERED_COLUMNS)]
    features = FE.engineered(daily, FE.ticker_codes(companies), keep=carried)
    return features.withColumns({n: c for n, c in FE.same_day_columns().items() if n not in features.columns})


def train(spark: SparkSession, root: str, companies: DataFrame, name: str, columns: Sequence[str] = tuple(C.REGRESSION_COLUMNS)) -> int:
    """Fit the chain on all stored daily rows and store it as the next version of ``name``, which it returns."""
    features = price_features(ST.read_range_table(spark, f"{root}/daily", DAILY), companies)
    features = ST.cut_lineage(features.select("Ticker", "News_Date", *dict.fromkeys((*columns, "Open", "Close"))))
    known = RG.next_day_targets(features).where(" AND ".join(f"Next_{t} IS NOT NULL" for t in RG.TARGETS)).count()
    if not known:
        raise ValueError("no stored day has a next session to learn from")
    fit, model = RG.train(features, columns)
    return RG.store_models(spark, f"{root}/models", name, fit, model, known)


def monitor(spark: SparkSession, root: str, horizon: int = 0) -> tuple[DataFrame, DataFrame]:
    """Accuracy of the stored predictions and its alerts.

    Only days whose tables changed since the last check are measured. Groups of which a day was measured are
    appended to the performance and alert tables; a check without news appends nothing.
    """
    parts, touched = MO.measure_changed_days(spark, root, horizon)
    measured = FC.merged_accuracy(parts).withColumn("Evaluated_At", F.current_timestamp())
    found = ST.cut_lineage(conform(measured, PERFORMANCE))
    fresh = ST.cut_lineage(found.join(touched, MO.GROUP, "left_semi"))
    if not fresh.isEmpty():
        ST.append_rows(fresh, f"{root}/performance", PERFORMANCE, partition=None)
        FC.alerts(conform(fresh, PERFORMANCE)).write.mode("append").parquet(f"{root}/alerts")
    return found, FC.alerts(found)


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("job", choices=["run", "train", "monitor"])
    ap.add_argument("--feed", help="JSON lines of feed rows with Ticker and ord")
    ap.add_argument("--bars", help="Parquet table of daily bars")
    ap.add_argument("--root", required=True, help="folder of the stored tables")
    ap.add_argument("--start", type=date.fromisoformat)
    ap.add_argument("--end", type=date.fromisoformat)
    ap.add_argument("--horizon", type=int, default=0)
    ap.add_argument("--companies", help="JSON lines of companies instead of the built-in ones")
    ap.add_argument("--holidays", help="text file of ISO dates instead of the built-in ones")
    ap.add_argument("--models", help="stored price models that predict, by name, or all")
    ap.add_argument("--name", default="pca_regression", help="name of the model to train")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"presspulse-{args.job}").getOrCreate()
    if args.job == "monitor":
        measured, alerts = monitor(spark, args.root, args.horizon)
        print(f"{measured.count()} groups measured, {alerts.count()} of them alert; news added to {args.root}/performance and /alerts")
        return
    companies = spark.read.schema(COMPANIES).json(args.companies) if args.companies else company_table(spark)
    if args.job == "train":
        print(f"version {train(spark, args.root, companies, args.name)} of {args.name} added to {args.root}/models")
        return
    # the page of an article, if the feed has it, gives the summary where there is no description
    schema = T.StructType([*RAW_ARTICLE.fields]).add("Ticker", "string").add("ord", "long").add("Html", "string")
    feed = spark.read.schema(schema).json(args.feed)
    bars = ST.read_or_empty(spark, args.bars, OHLCV)
    holidays = tuple(r[0] for r in spark.read.text(args.holidays).collect()) if args.holidays else tuple(C.HOLIDAYS)
    names = None if args.models == "all" else (args.models or "").split(",")
    prices = RG.stored_models(spark, f"{args.root}/models", names) if args.models else ()
    days = run(feed, bars, companies, args.root, args.start, args.end, Plugins(prices=prices), holidays)
    days.write.mode("append").parquet(f"{args.root}/runs")
    print(f"counts of {days.count()} days added to {args.root}/runs")


if __name__ == "__main__":
    main()
