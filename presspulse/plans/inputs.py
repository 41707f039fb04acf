"""Input views over the given tables: bars, companies, article feed, stand-in model scores.

The tables hold no news feed or price history of their own, so these views derive them:
line items are trades of their part's brand, events are articles about a company.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions import market_time as M
from presspulse.operators.forecast import predict_long
from presspulse.sources.storage import broadcast_if_small, dealt_for_texts, read_table, spread_if_narrow

HOLIDAYS = ("2024-01-26",)
BAR_SHIFT_DAYS = 8122  # moves the bars next to the articles in time
TOPIC_MULTIPLIERS = (1.0, 1.2, 0.9, 1.1, 1.0, 0.8)
SOURCE_TABLE = tuple(C.SOURCE_RELIABILITY)

HEADLINE_TEMPLATES = (
    "{c} CEO resigns amid controversy",
    "Chairman resigned after {c} board meeting",
    "{c} Wins Major Order Worth Rs 5000 Crore",
    "{c} bags mega deal with government",
    "{c} Reports Q2 Results, Net Profit Jumps 20%",
    "{c} announces final dividend of Rs 5 per share",
    "Analysts discuss {c} outlook for next year",
    "{c} board approves buyback!",
    "Regulator fined {c}",
    "{c} rated AA+ by agency",
    "Market closes flat",
    "{a} SHARES STEADY",
)


def bars(spark: SparkSession, folder: str, after: Column | None = None) -> DataFrame:
    """Daily bars per brand: first and last trade by a total trade order; optionally only days after one.

    Ordered aggregates instead of ranked rows: trades are pre-aggregated where they are read, and
    only one row per brand, day and input partition is shuffled.
    """
    rows = spread_if_narrow(read_table(spark, folder, "lineitem"))
    if after is not None:
        # on the stored column, so that the scan can skip what lies before
        rows = rows.where(F.col("l_shipdate") >= F.date_add(after, 1).cast("timestamp_ntz"))
    parts = read_table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("Ticker"))
    # what is derived of a trade is made after the join, which may shuffle the trades
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    trades = rows.select(*names, "l_shipdate").join(parts, "l_partkey").select(
        "Ticker",
        F.to_date("l_shipdate").alias("Date"),
        F.try_divide("l_extendedprice", "l_quantity").alias("px"),
        F.col("l_quantity").alias("q"),
        F.struct(*names).alias("seq"),
    )
    return (
        trades.groupBy("Ticker", "Date")
        .agg(
            F.min_by("px", "seq").alias("Open"),
            F.max("px").alias("High"),
            F.min("px").alias("Low"),
            F.max_by("px", "seq").alias("Close"),
            F.sum("q").alias("Volume"),
        )
    )


def bars_2024(spark: SparkSession, folder: str) -> DataFrame:
    return bars(spark, folder).withColumn("Date", F.date_add("Date", BAR_SHIFT_DAYS))


def companies(spark: SparkSession, folder: str) -> DataFrame:
    number = F.substring("ticker", 7, 10)
    return (
        read_table(spark, folder, "part")
        .select(F.col("p_brand").alias("ticker"))
        .distinct()
        .select(
            "ticker",
            F.concat(F.lit("Brand "), number, F.lit(" Energy")).alias("name"),
            F.lit("Energy").alias("sector"),
            F.array(F.concat(F.lit("BRK"), number)).alias("aliases"),
            F.array(F.concat(F.lit("Keyword "), number)).alias("keywords"),
        )
    )


def feed_ticker() -> Column:
    return F.concat(F.lit("Brand#"), (F.col("user_id") % 25 + 1).cast("string"))


def feed_times(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """Order, company and IST time of every article; reads three columns only."""
    events = read_table(spark, folder, "events") if events is None else events
    return events.select(
        F.col("event_id").alias("ord"), feed_ticker().alias("Ticker"), M.to_ist(F.col("ts")).alias("Published_At")
    )


def _publisher() -> Column:
    pick = F.col("event_id") % 6
    return (
        F.when(pick == 0, "Reuters").when(pick == 1, "The Economic Times Online").when(pick == 2, "Some Blog")
        .when(pick == 3, "").when(pick == 4, F.lit(None)).otherwise("Hindustan Times")
    )


def articles(
    spark: SparkSession, folder: str, text: bool = True, url: bool = True, events: DataFrame | None = None
) -> DataFrame:
    """Article feed. ``text`` and ``url`` say which joins the caller needs; bodies are whole documents.

    The bodies are joined last, so that no shuffle or sort carries them with the events.
    """
    events = read_table(spark, folder, "events") if events is None else events
    cos = companies(spark, folder).select("ticker", F.col("name").alias("Company"), F.col("aliases")[0].alias("__alias"))
    df = events.select("event_id", "ts", "event_type", feed_ticker().alias("ticker")).join(broadcast_if_small(cos), "ticker")
    extra = []
    if url:
        pages = read_table(spark, folder, "pages")
        total = pages.select(F.count(F.lit(1))).scalar()
        df = df.withColumn("page_id", F.col("event_id") % total).join(pages.select("page_id", "url"), "page_id")
        www = F.concat(F.lit("https://www."), F.expr("substr(url, instr(url, '//') + 2)"))
        extra.append(F.when(F.col("event_type") == "click", www).otherwise(F.col("url")).alias("URL"))
    if text:
        docs = read_table(spark, folder, "documents")
        total = docs.select(F.count(F.lit(1))).scalar()
        df = dealt_for_texts(df.withColumn("doc_id", F.col("event_id") % total), "doc_id")
        df = df.join(docs.select("doc_id", F.col("text").alias("Description")), "doc_id")
        extra.insert(0, F.col("Description"))
    template = F.element_at(
        F.array(*[F.lit(t) for t in HEADLINE_TEMPLATES]), ((F.col("event_id") * 7) % len(HEADLINE_TEMPLATES) + 1).cast("int")
    )
    title = F.replace(F.replace(template, F.lit("{c}"), F.col("Company")), F.lit("{a}"), F.col("__alias"))
    return df.select(
        F.col("event_id").alias("ord"),
        F.col("ticker").alias("Ticker"),
        "Company",
        M.to_ist(F.col("ts")).alias("Published_At"),
        title.alias("Headline"),
        _publisher().alias("Publisher"),
        *extra,
    )


_SENTIMENT_TERMS = ((37, 101), (53, 97), (71, 89))
_TOPIC_TERMS = ((3, 7), (5, 11), (7, 13), (11, 17), (13, 19), (17, 23))


def with_scores(df: DataFrame) -> DataFrame:
    """Stand-in classifier output, a function of the article number; probabilities sum to 1."""

    def parts(terms: tuple) -> list[Column]:
        return [((F.col("ord") * m) % n + 1).cast("double") for m, n in terms]

    pos, neu, neg = parts(_SENTIMENT_TERMS)
    topics = parts(_TOPIC_TERMS)
    topic_sum = topics[0]
    for t in topics[1:]:
        topic_sum = topic_sum + t
    return df.withColumns(
        {
            "Sentiment_Positive": pos / (pos + neu + neg),
            "Sentiment_Neutral": neu / (pos + neu + neg),
            "Sentiment_Negative": neg / (pos + neu + neg),
            **{c: t / topic_sum for c, t in zip(C.TOPIC_COLUMNS, topics)},
        }
    ).withColumn("Sentiment_Score", F.col("Sentiment_Positive") - F.col("Sentiment_Negative"))


def scores(spark: SparkSession, folder: str) -> DataFrame:
    return with_scores(read_table(spark, folder, "events").select(F.col("event_id").alias("ord")))


def naive(df: DataFrame) -> Column:
    return F.col("Close") * F.lit(1.01)


def swing(df: DataFrame) -> Column:
    return F.col("Close") + (F.col("Close") - F.col("Open")) * F.lit(1.5)


FORMULA_SPECS = [
    (C.ModelSpec(name, target, "formula", "stock_news_v1", "stock_news_row", None, None, name == "swing"), fn)
    for name, fn in (("naive", naive), ("swing", swing))
    for target in ("Open", "Close")
]


def history(spark: SparkSession, folder: str) -> DataFrame:
    """Daily rows over the whole price history, with stand-in sentiment and topic values per row."""
    df = bars(spark, folder).withColumnRenamed("Date", "News_Date")
    day = F.datediff("News_Date", F.lit("1970-01-01").cast("date"))
    brand = F.substring("Ticker", 7, 10).cast("int")
    topics = [((day * m + brand) % n + 1).cast("double") for m, n in _TOPIC_TERMS]
    topic_sum = topics[0]
    for t in topics[1:]:
        topic_sum = topic_sum + t
    return df.withColumns(
        {
            "Sentiment_Score": ((day * 7 + brand * 3) % 21 - 10) / F.lit(10.0),
            **{c: t / topic_sum for c, t in zip(C.TOPIC_COLUMNS, topics)},
        }
    )


def formula_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of the two formula models for every bar."""
    df = bars(spark, folder).withColumnRenamed("Date", "News_Date")
    return predict_long(df, [(s, fn(df)) for s, fn in FORMULA_SPECS], ["Ticker", "News_Date"])
