"""Connected components of a graph in a table, by rounds of joins with reliable checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presspulse.sources.storage import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of ``edges(a, b)``; the component is its smallest node.

    Alternates two steps until nothing changes: every node links its larger neighbours to the smallest
    node it knows, then its smaller ones. Paths halve, so rounds grow with the logarithm of a
    component's size. A round is a pre-aggregated minimum per node and a join, so a node with very many
    links is no single task's work. Loops and null ends are ignored.
    """
    now = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        now = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        least = now.groupBy("u").agg(F.min("v").alias("m"))
        held = now.join(least, "u")
        now = cut_lineage(
            held.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(held.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
