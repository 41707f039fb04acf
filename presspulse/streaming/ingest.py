"""Incremental ingest: new feed files since the last run, into a table of distinct articles per day.

Below the root: ``progress`` of the stream; ``arrived/batch=<id>/stored=<flag>`` with the whole rows;
``state``, one version of narrow rows a day.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presspulse import config as C
from presspulse.functions import market_time as M
from presspulse.operators import news as N
from presspulse.operators.daily import DAY
from presspulse.sources.storage import (
    MAX_BROADCAST_KEYS,
    MAX_BROADCAST_ROWS,
    broadcast_if_small,
    cut_lineage,
    read_or_empty,
    read_range_table,
    replace_listed,
)

KEYS = {"url_key": "URL_Key", "headline_key": "Headline_Key"}


def arrived_schema(articles: T.StructType) -> T.StructType:
    """The article columns with their news date and duplicate keys; all of them may be null."""
    added = [T.StructField("News_Date", T.DateType()), *[T.StructField(k, T.StringType()) for k in KEYS.values()]]
    return T.StructType([*[T.StructField(f.name, f.dataType) for f in articles.fields if f.name != "News_Date"], *added])


def state_schema(articles: T.StructType) -> T.StructType:
    """What is kept of each arrived row to settle duplicates: its keys, the batch that stores it, whether it
    survives now (``kept``) and whether it did when it was stored."""
    text = [T.StructField(k, T.StringType()) for k in KEYS]
    flags = [T.StructField("batch", T.LongType()), T.StructField("kept", T.BooleanType()), T.StructField("stored", T.BooleanType())]
    return T.StructType([T.StructField("News_Date", T.DateType()), articles["Ticker"], articles["ord"], *text, *flags])


def ingest_batch(articles: DataFrame, batch_id: int, root: str, holidays: Sequence[str]) -> None:
    """Store one batch of whole article rows and settle the days it touches.

    Which rows survive duplicate removal depends on the whole day in feed order, so late files may drop rows
    that were kept, or bring back others. This is settled among the narrow rows of the state: a batch reads
    itself and the state of its own days, and no article that came before. Whole rows are read for their keys,
    and then written once, apart by whether they survive so far: they are neither checkpointed nor sorted. Where
    survival changes later, the state says so. ``articles`` must give the same rows each time it is read. A batch
    that is run again replaces its own rows; rows of one ``ord`` are one article, which the first batch brought.
    Rows without a news date or a ticker are left out.
    """
    spark = articles.sparkSession
    dated = articles.withColumn("News_Date", M.news_date(F.col("Published_At"), holidays)).where("News_Date IS NOT NULL AND Ticker IS NOT NULL")
    schema, states = arrived_schema(articles.schema), state_schema(articles.schema)
    keyed = N.duplicate_keys(dated)
    narrow = cut_lineage(keyed.select(*DAY, "ord", *KEYS))
    days = {r["News_Date"] for r in narrow.select("News_Date").distinct().collect()}  # days of the calendar
    own = narrow.withColumns({"batch": F.lit(batch_id).cast("long"), "stored": F.lit(None).cast("boolean")})
    columns = [n for n in states.fieldNames() if n != "kept"]
    before = read_range_table(spark, f"{root}/state", states, days=days).where(F.col("batch") != batch_id)
    known = before.select(columns).unionByName(own.select(columns)).withColumn("place", F.struct("ord", "batch"))
    survivors = N.surviving_orders(known, DAY, "place").withColumn("kept", F.lit(True))
    marked = known.join(survivors, [*DAY, "place"], "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    settled = cut_lineage(marked.withColumn("stored", F.coalesce("stored", "kept")).drop("place"))
    rows = keyed.withColumnsRenamed(KEYS).select(schema.fieldNames())
    mine = settled.where(F.col("batch") == batch_id)
    keys = {flag: mine.where(F.col("stored") == flag).select(*DAY, "ord").distinct() for flag in (True, False)}
    counts = {flag: k.limit(MAX_BROADCAST_KEYS + 1).count() for flag, k in keys.items()}
    for flag in (True, False):
        _rows_of(rows, keys, counts, flag).write.mode("overwrite").option("compression", "zstd").parquet(
            f"{root}/arrived/batch={batch_id}/stored={str(flag).lower()}"
        )
    replace_listed(settled, f"{root}/state", states)


def _rows_of(rows: DataFrame, keys: dict[bool, DataFrame], counts: dict[bool, int], flag: bool) -> DataFrame:
    """The whole rows whose keys are those of ``flag``; each row's key is on one of both sides. Whichever keys are
    few are broadcast, so that whole rows are not shuffled; only a small result is, into few files."""
    on = [*DAY, "ord"]
    if counts[flag] <= MAX_BROADCAST_KEYS:
        picked = rows.join(F.broadcast(keys[flag]), on, "left_semi")
        return picked.hint("rebalance", "News_Date") if counts[flag] <= MAX_BROADCAST_ROWS else picked
    if counts[not flag] <= MAX_BROADCAST_KEYS:
        return rows.join(F.broadcast(keys[not flag]), on, "left_anti")
    return rows.join(keys[flag], on, "left_semi")


def surviving_articles(spark: SparkSession, root: str, articles: T.StructType) -> DataFrame:
    """The whole rows of all distinct articles. Rows stored as surviving are a plain scan; those of which late
    files have changed it are few, and the only ones that a join has to find."""
    schema = arrived_schema(articles)
    where = [T.StructField("batch", T.LongType()), T.StructField("stored", T.BooleanType())]
    rows = read_or_empty(spark, f"{root}/arrived", T.StructType([*schema.fields, *where]))
    state = read_range_table(spark, f"{root}/state", state_schema(articles))
    place = ["batch", *DAY, "ord"]
    changed = broadcast_if_small(state.where("kept <> stored").select(place), MAX_BROADCAST_KEYS)
    kept = rows.where("stored").join(changed, place, "left_anti")
    back = rows.where("NOT stored").join(changed, place, "left_semi")
    return kept.unionByName(back).select(schema.fieldNames())


def ingest_articles(
    stream: DataFrame,
    to_articles: Callable[[DataFrame], DataFrame],
    root: str,
    holidays: Sequence[str] = tuple(C.HOLIDAYS),
) -> DataFrame:
    """Process all files that are there and return the table of whole article rows. ``root`` keeps the
    progress, so the next call handles only files that have come since. ``to_articles`` shapes the rows and
    may leave some out, such as those without a mention of their company."""

    def run(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(to_articles(batch), batch_id, root, holidays)

    (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    spark = stream.sparkSession
    shape = to_articles(spark.createDataFrame([], stream.schema)).schema
    return surviving_articles(spark, root, shape)
