"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presspulse.llm.centroids import clusters
from presspulse.llm.decontaminate import contaminations
from presspulse.llm.html_text import extracted_text
from presspulse.llm.near_dedup import near_duplicate_classes
from presspulse.llm.ngram_quality import perplexity_quality
from presspulse.llm.packing import packed_pieces
from presspulse.llm.piece_spans import digests
from presspulse.llm.pii import listed, personal_data
from presspulse.llm.quality_rules import line_quality
from presspulse.llm.statements import LINE_QUALITY
from presspulse.llm.toxicity import score_toxicity
from presspulse.llm.url_filter import judged_urls
from presspulse.llm.warc import round_trip
from presspulse.llm.whitening import whitened_rows
from presspulse.sources.storage import read_table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(read_table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[number(k) for k in ("email", "ip", "card", "phone")],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "added")).alias("spans"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(read_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "pages"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted_text(read_table(spark, sf_dir, "pages"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_urls(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(read_table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(read_table(spark, sf_dir, "embeddings"))


def op12_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_rows(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_quality_rules, op3_toxicity, op4_ngram_quality, op5_pii, op6_packing, op7_warc, op8_html_text, op9_url_filter, op10_near_dedup,
        op11_centroids, op12_piece_spans, op13_whitening,
    )
}
ORACLES = {"op2_quality_rules": LINE_QUALITY}
