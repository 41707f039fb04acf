"""Shared inputs of the operator tests."""

from __future__ import annotations

from pathlib import Path

FOLDER = "/root/testdata/sf0.001"
HAS_TABLES = Path(FOLDER).exists()
# columns whose names operators use inside themselves, on top of those of documents
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n int, key string, words string, bag string, toxic string, start long, class_id string"
LABELS = "doc_id long, quality int, toxic int, n int"


def docs(spark, texts, schema=DOCS):
    """Documents of ``(id, text)`` pairs; the other columns hold something, too."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "k", "w", "b", "t", 7, "c") for i, t in texts], schema)


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def awkward(long_text="x y z " * 40_000):
    """Nulls, empty and very long texts, repeated rows."""
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long_text), (6, "same words here again and so on"), (6, "same words here again and so on"), (None, "no id at all"), (None, None)]
