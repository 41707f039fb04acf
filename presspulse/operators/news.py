"""Operators over article rows: feed shaping, per-company cap, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions.text import canonical_url, normalize_headline, parse_published_at, publisher_from_url
from presspulse.sources.storage import cut_lineage

# --- feed ----------------------------------------------------------------------------


def scan_feed(raw: DataFrame, naive_offset_minutes: int = 0) -> DataFrame:
    """Raw feed rows (nested publisher, text date) to article columns; unscored columns stay absent."""
    return raw.select(
        F.coalesce(F.col("title"), F.lit("")).alias("Headline"),
        F.coalesce(F.col("description"), F.lit("")).alias("Summary"),
        F.coalesce(F.col("url"), F.lit("")).alias("URL"),
        source_name(F.col("publisher.title"), F.col("url")).alias("Source"),
        parse_published_at(F.col("published date"), naive_offset_minutes).alias("Published_At"),
        *[c for c in raw.columns if c not in ("title", "description", "url", "publisher", "published date")],
    )


def source_name(publisher: Column, url: Column) -> Column:
    return F.coalesce(F.nullif(publisher, F.lit("")), publisher_from_url(url))


# --- per-company cap -------------------------------------------------------------------


def first_per_group(df: DataFrame, keys: Sequence[str], order: str, n: int = C.MAX_ARTICLES_PER_COMPANY) -> DataFrame:
    """First ``n`` rows per group in feed order. The limit on the rank lets Spark keep only ``n``
    rows per group and input partition before the shuffle, so a hot group does not travel whole."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n).drop("__rank")


# --- duplicates --------------------------------------------------------------------------


def duplicate_keys(df: DataFrame, url: str = "URL", headline: str = "Headline") -> DataFrame:
    return df.withColumns(
        {"url_key": canonical_url(F.col(url)), "headline_key": normalize_headline(F.col(headline))}
    )


def surviving_orders(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keys and order values of the rows that first-wins duplicate removal keeps, any group size.

    No group is ever gathered. Copies with both keys equal collapse first, in a pre-aggregated
    group-by. Then each round keeps the rows that come first among their URL key and among their
    headline key, drops the rows that share a key with a kept one, and passes the others on. The
    first row of each key is pre-aggregated, and joining it back gives one small row per key, so a
    hot key splits under adaptive skew handling. Every round settles at least the earliest open
    row of each group, and rounds go on until none is open.
    """
    keys = list(keys)
    has_url, has_head = F.col("url_key") != "", F.col("headline_key") != ""
    pairs = (
        df.where(has_url | has_head).groupBy(*keys, "url_key", "headline_key").agg(F.min(order).alias(order))
    )
    kept = df.where(~has_url & ~has_head).select(*keys, order)
    open_rows = cut_lineage(pairs)
    while not open_rows.isEmpty():
        first = {
            k: open_rows.where(F.col(k) != "").groupBy(*keys, k).agg(F.min(order).alias(f"first_{k}"))
            for k in ("url_key", "headline_key")
        }
        marked = open_rows
        for k, low in first.items():
            marked = marked.join(low, [*keys, k], "left")
        leads_url = ~has_url | (F.col("first_url_key") == F.col(order))
        leads_head = ~has_head | (F.col("first_headline_key") == F.col(order))
        marked = cut_lineage(
            marked.select(*keys, "url_key", "headline_key", order, (leads_url & leads_head).alias("wins"))
        )
        winners = marked.where("wins")
        kept = kept.unionByName(winners.select(*keys, order))
        rest = marked.where("NOT wins")
        if rest.isEmpty():
            break
        for k in first:
            rest = rest.join(winners.where(F.col(k) != "").select(*keys, k), [*keys, k], "left_anti")
        open_rows = cut_lineage(rest.select(*keys, "url_key", "headline_key", order))
    return kept


def dedupe(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """First-wins duplicate removal for groups of any size; ``order`` is unique within a group."""
    return df.join(surviving_orders(df, keys, order), [*keys, order], "left_semi")
