"""Typed schemas of the stored tables and conversion helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presspulse.config import TOPIC_COLUMNS


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
    "array<double>": T.ArrayType(T.DoubleType()),
    "publisher": T.StructType([T.StructField("title", T.StringType()), T.StructField("href", T.StringType())]),
}


def _struct(*fields: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


_TOPICS = [(c, "double") for c in TOPIC_COLUMNS]

RAW_ARTICLE = _struct(
    ("title", "string"), ("description", "string"), ("url", "string"),
    ("published date", "string"), ("publisher", "publisher"),
)

OHLCV = _struct(
    ("Ticker", "string"), ("Date", "date"), ("Open", "double"), ("High", "double"), ("Low", "double"),
    ("Close", "double"), ("Adj_Close", "double"), ("Volume", "double"),
)

ARTICLES = _struct(
    ("Ticker", "string"), ("Company", "string"), ("News_Date", "date"), ("Published_At", "timestamp_ntz"),
    ("Headline", "string"), ("Summary", "string"), ("URL", "string"), ("Source", "string"),
    ("Sentiment_Positive", "double"), ("Sentiment_Neutral", "double"), ("Sentiment_Negative", "double"),
    ("Sentiment_Score", "double"), ("Sentiment_Label", "string"),
    *_TOPICS,
    ("Predicted_Topic", "string"), ("Article_Relevance", "double"), ("Headline_Strength", "double"),
    ("Source_Reliability", "double"), ("Recency_Weight", "double"), ("Company_Weight", "double"),
    ("Topic_Weight", "double"), ("News_Impact_Weight", "double"),
)

DAILY = _struct(
    ("Ticker", "string"), ("Company", "string"), ("News_Date", "date"),
    ("Open", "double"), ("High", "double"), ("Low", "double"), ("Close", "double"), ("Adj_Close", "double"),
    ("Volume", "double"),
    ("Sentiment_Score", "double"), ("Sentiment_Positive", "double"), ("Sentiment_Neutral", "double"),
    ("Sentiment_Negative", "double"), ("Sentiment_Label", "string"),
    *_TOPICS,
    ("Predicted_Topic", "string"), ("Headlines", "string"), ("Article_Count", "bigint"), ("Volatility", "double"),
)

PREDICTIONS = _struct(
    ("Ticker", "string"), ("Company", "string"), ("News_Date", "date"), ("Model_Name", "string"),
    ("Backend", "string"), ("Target", "string"), ("Predicted_Value", "double"), ("Raw_Predicted_Value", "double"),
    ("Last_Close", "double"), ("Actual_Value", "double"), ("Unverified", "boolean"), ("Predicted_At", "timestamp"),
)

PERFORMANCE = _struct(
    ("Ticker", "string"), ("Model_Name", "string"), ("Target", "string"), ("Evaluated_At", "timestamp"),
    ("N_Samples", "bigint"), ("MAE", "double"), ("RMSE", "double"), ("MAPE", "double"), ("R2", "double"),
    ("Direction_Accuracy", "double"),
)

ACCURACY_PARTS = _struct(
    ("Ticker", "string"), ("Model_Name", "string"), ("Target", "string"), ("News_Date", "date"),
    ("n", "bigint"), ("n_missing", "bigint"), ("abs_error", "double"), ("sq_error", "double"), ("n_ratio", "bigint"),
    ("ratio", "double"), ("mean", "double"), ("spread", "double"), ("low", "double"), ("high", "double"), ("hits", "bigint"),
)

PRICE_MODELS = _struct(
    ("name", "string"), ("version", "bigint"), ("target", "string"), ("columns", "array<string>"), ("mean", "array<double>"),
    ("std", "array<double>"), ("weights", "array<double>"), ("intercept", "double"), ("trained_rows", "bigint"),
    ("trained_at", "timestamp"),
)

COMPANIES = _struct(
    ("name", "string"), ("ticker", "string"), ("sector", "string"),
    ("aliases", "array<string>"), ("keywords", "array<string>"),
)


def finite(c: Column) -> Column:
    """NaN and infinities become NULL, so that NULL is the only 'missing'."""
    bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(~bad, c)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to exactly ``schema``: order fixed, missing columns NULL, extra columns dropped."""
    have = {c.lower() for c in df.columns}  # names resolve as in Spark, without regard to case
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
