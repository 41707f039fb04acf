"""Model plug-ins over text: keyed enrichment, batch scorers, embeddings."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presspulse import config as C
from presspulse.functions.isolation import score_rows
from presspulse.functions.scoring import topic_overlap_scores
from presspulse.functions.text import bind, stable_hash, token_set
from presspulse.sources.storage import read_or_empty

SENTIMENT_LABELS = ("positive", "neutral", "negative")
SENTIMENT = T.StructType([T.StructField(x, T.DoubleType()) for x in SENTIMENT_LABELS]).add("failed", "boolean")

# A batch scorer takes the texts of one batch and returns one row of three columns per text.
BatchScorer = Callable[[pd.Series], pd.DataFrame]


def keyed_texts(df: DataFrame, text: str) -> DataFrame:
    """Distinct non-empty texts by content hash. Copies collapse before the shuffle."""
    return (
        df.where(F.coalesce(F.col(text), F.lit("")) != "")
        .select(stable_hash(F.col(text)).alias("key"), F.col(text).alias("text"))
        .groupBy("key")
        .agg(F.first("text").alias("text"))
    )


def misses(keyed: DataFrame, cache: DataFrame) -> DataFrame:
    """Texts whose key the cache does not hold."""
    return keyed.join(cache.select("key"), "key", "left_anti")


# --- a cache of one row a key --------------------------------------------------------------------

# Of each stored row: when its write began, and which write it was.
WRITE = [T.StructField("written", T.TimestampType()), T.StructField("writer", T.StringType())]


def _stored(spark: SparkSession, cache_path: str, schema: T.StructType, encoder: str) -> DataFrame:
    return read_or_empty(spark, f"{cache_path}/encoder={encoder}", T.StructType([*schema.fields, *WRITE]))


def cached(spark: SparkSession, cache_path: str, schema: T.StructType, encoder: str = "1") -> DataFrame:
    """The cache of one version of an encoder, one row a key: that of the newest write.

    Runs that overlap may both compute and store a key; nothing locks them out, and whichever wrote
    last is read. The newest row is a mergeable maximum, so it costs the one shuffle by key that the
    join with the texts needs anyhow.
    """
    values = [c for c in schema.fieldNames() if c != "key"]
    newest = F.max_by(F.struct(*values), F.struct("written", "writer"))
    return _stored(spark, cache_path, schema, encoder).groupBy("key").agg(newest.alias("v")).select("key", "v.*")


def fill(df: DataFrame, text: str, cache_path: str, schema: T.StructType, scorer: Callable[[DataFrame], DataFrame], encoder: str = "1") -> None:
    """Compute the scorer's output for the texts that the cache does not hold yet, and store it.

    The scorer gets distinct ``(key, text)`` rows and adds the value columns. ``encoder`` names its version: values
    of another version are never used.
    """
    spark = df.sparkSession
    new = scorer(misses(keyed_texts(df, text), _stored(spark, cache_path, schema, encoder)))
    stamp = {"written": F.current_timestamp(), "writer": F.lit(uuid.uuid4().hex)}
    new.select(schema.fieldNames()).withColumns(stamp).write.mode("append").parquet(f"{cache_path}/encoder={encoder}")


def enrich(df: DataFrame, text: str, cache_path: str, schema: T.StructType, scorer: Callable[[DataFrame], DataFrame], encoder: str = "1") -> DataFrame:
    """Attach cached scorer output to every row; only texts not yet in the cache are computed.

    ``schema`` is the cache's: ``key`` and the value columns. New values are appended and read back
    from storage, so they are computed once however often the result is used. A text that occurs
    in many rows meets its one cache row in a join that adaptive execution splits when skewed.
    """
    fill(df, text, cache_path, schema, scorer, encoder)
    values = cached(df.sparkSession, cache_path, schema, encoder)
    return df.withColumn("key", stable_hash(F.col(text))).join(values, "key", "left").drop("key")


# --- scorers -------------------------------------------------------------------------------------


def batch_sentiment(scorer: BatchScorer) -> Callable[[Column], Column]:
    """Wrap a batch scorer as a vectorised UDF. Texts whose scoring fails alone are neutral and marked
    as failed; the other texts of their batch are scored without them."""

    @F.pandas_udf(SENTIMENT)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            known = texts.fillna("").reset_index(drop=True)

            def run(part: slice) -> np.ndarray:
                out = scorer(known.iloc[part].reset_index(drop=True))[list(SENTIMENT_LABELS)]
                if len(out) != part.stop - part.start:
                    raise ValueError("a scorer must return one row per text")
                return out.to_numpy("float64")

            values, failed = score_rows(run, len(known), len(SENTIMENT_LABELS))
            values[failed] = (0.0, 1.0, 0.0)
            yield pd.DataFrame(dict(zip(SENTIMENT_LABELS, values.T)), index=texts.index).assign(failed=failed)

    return score


def score_sentiment(df: DataFrame, text: str, scorer: BatchScorer) -> DataFrame:
    """Add the three sentiment probabilities, the signed score, and whether the scorer failed on the row."""
    scored = df.withColumn("__s", batch_sentiment(scorer)(F.col(text)))
    return scored.withColumns(
        {
            "Sentiment_Positive": F.col("__s.positive"),
            "Sentiment_Neutral": F.col("__s.neutral"),
            "Sentiment_Negative": F.col("__s.negative"),
            "Sentiment_Score": F.col("__s.positive") - F.col("__s.negative"),
            "Sentiment_Failed": F.col("__s.failed"),
        }
    ).drop("__s")


EMBEDDINGS = T.StructType([T.StructField("key", T.StringType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])
HASHED_ENCODER = "hashed-64"


def hashed_embedding(df: DataFrame, text: str, dims: int = 64, out: str = "embedding") -> DataFrame:
    """Built-in encoder: unit-length counts of the distinct words by hash, row by row in the JVM.

    A word's dimension is the number in the first eight hexadecimal digits of its MD5, modulo ``dims``. A
    text without words has the zero vector.
    """
    dimension = lambda w: F.pmod(F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long"), F.lit(dims))
    count = lambda at, d: (F.size(at) - F.size(F.array_remove(at, d))).cast("double")
    every = F.sequence(F.lit(0).cast("long"), F.lit(dims - 1).cast("long"))
    counts = bind(F.transform(token_set(F.col(text)), dimension), lambda at: F.transform(every, lambda d: count(at, d)))
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))
    unit = lambda s: F.transform(s["c"], lambda x: F.coalesce(F.try_divide(x, s["n"]), F.lit(0.0)))
    return df.withColumn(out, bind(bind(counts, lambda c: F.struct(c.alias("c"), norm(c).alias("n"))), unit))


# --- a stand-in batch scorer -------------------------------------------------------------------

POSITIVE_WORDS = frozenset("the win wins profit jumps order dividend growth".split())
NEGATIVE_WORDS = frozenset("and loss fined resigns resigned probe falls".split())


def word_list_scorer(texts: pd.Series) -> pd.DataFrame:
    """Smoothed share of listed words; stands where a trained classifier is plugged in."""
    words = texts.str.lower().str.findall("[a-z]+")
    p = words.map(lambda ws: sum(w in POSITIVE_WORDS for w in ws)).astype("float64")
    n = words.map(lambda ws: sum(w in NEGATIVE_WORDS for w in ws)).astype("float64")
    total = p + n + 1.0
    return pd.DataFrame({"positive": p / total, "neutral": 1.0 / total, "negative": n / total})


def word_list_sentiment(df: DataFrame, text: str = "Scoring_Text") -> DataFrame:
    """The probabilities of ``word_list_scorer`` and the signed score, as expressions in the JVM."""

    def shares(words: Column) -> Column:
        listed = lambda held: F.size(F.filter(words, lambda w: w.isin(sorted(held)))).cast("double")
        return bind(F.struct(listed(POSITIVE_WORDS).alias("p"), listed(NEGATIVE_WORDS).alias("n")), probabilities)

    def probabilities(c: Column) -> Column:
        total = c["p"] + c["n"] + 1.0
        return F.struct((c["p"] / total).alias("p"), (1.0 / total).alias("u"), (c["n"] / total).alias("n"))

    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    scored = df.withColumn("__s", bind(words, shares))
    return scored.withColumns(
        {
            "Sentiment_Positive": F.col("__s.p"),
            "Sentiment_Neutral": F.col("__s.u"),
            "Sentiment_Negative": F.col("__s.n"),
            "Sentiment_Score": F.col("__s.p") - F.col("__s.n"),
        }
    ).drop("__s")


def description_topics(df: DataFrame, text: str = "Scoring_Text") -> DataFrame:
    """The topic probabilities of the built-in topic scorer."""
    scored = df.withColumn("__topics", topic_overlap_scores(F.col(text)))
    return scored.withColumns({c: F.get("__topics", F.lit(i)) for i, c in enumerate(C.TOPIC_COLUMNS)}).drop("__topics")
