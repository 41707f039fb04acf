"""Corpus preparation: toxicity, near-duplicates, benchmark decontamination, personal data, packing.

Every stage takes the documents that its predecessor kept and returns those it keeps, with the columns
of ``documents``; the last one returns the packed pieces. Nulls, empty texts and repeated rows are treated
as the operators' descriptions say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presspulse.llm.decontaminate import drop_contaminated
from presspulse.llm.near_dedup import keep_one
from presspulse.llm.packing import packed_pieces
from presspulse.llm.pii import redact
from presspulse.llm.toxicity import drop_toxic
from presspulse.sources.storage import new_path, read_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: that of the smallest id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in their texts is replaced by its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packed_pieces(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("packing", packing),
]

#: Trained models and band joins are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
