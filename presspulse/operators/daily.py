"""Weights, daily aggregation and validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions import scoring as S
from presspulse.schemas import finite

DAY = ("Ticker", "News_Date")
WEIGHTED = ("Sentiment_Score", "Sentiment_Positive", "Sentiment_Neutral", "Sentiment_Negative", *C.TOPIC_COLUMNS)


def normalized(raw: Column, total: Column, n: Column) -> Column:
    """Share of the group total; a total that is not positive gives uniform shares."""
    return F.when(total > 0, F.try_divide(raw, total)).otherwise(F.lit(1.0) / n)


def normalize_weights(df: DataFrame, raw: str, out: str, keys: Sequence[str] = DAY) -> DataFrame:
    """Shares within groups of any size: totals are pre-aggregated and joined back, so a hot group
    is never brought into one task."""
    totals = df.groupBy(*keys).agg(F.sum(raw).alias("__total"), F.count(F.lit(1)).alias("__n"))
    joined = df.join(totals, list(keys))
    return joined.withColumn(out, normalized(F.col(raw), F.col("__total"), F.col("__n"))).drop("__total", "__n")


def weighted_sums(weight: str, columns: Sequence[str] = WEIGHTED) -> list[Column]:
    """Weighted sums with missing products skipped; all missing gives 0."""
    return [F.coalesce(F.sum(finite(F.col(c) * F.col(weight))), F.lit(0.0)).alias(c) for c in columns]


def aggregate_unnormalized(df: DataFrame, raw: str, columns: Sequence[str] = WEIGHTED) -> DataFrame:
    """Weighted day means straight from raw weights, for groups of any size.

    Dividing the weighted sums by the weight total equals normalising first, and needs one
    pre-aggregated pass instead of a join back to the rows. A total that is not positive gives
    plain means.
    """
    total, n = F.col("__total"), F.col("Article_Count")
    sums = {c: (F.sum(finite(F.col(c) * F.col(raw))), F.sum(finite(F.col(c)))) for c in columns}
    agg = df.groupBy(*DAY).agg(
        F.sum(raw).alias("__total"),
        F.count(F.lit(1)).alias("Article_Count"),
        *[x.alias(f"__{k}_{c}") for c, pair in sums.items() for k, x in zip("wp", pair)],
    )
    means = {
        c: F.coalesce(
            F.when(total > 0, F.try_divide(F.col(f"__w_{c}"), total)).otherwise(F.col(f"__p_{c}") / n), F.lit(0.0)
        )
        for c in columns
    }
    return agg.select(*DAY, *[m.alias(c) for c, m in means.items()], "Article_Count")


def joined_headlines(order: str, headline: str = "Headline") -> Column:
    """All headlines of a group in feed order; the result is one string, so only they and their order are gathered."""
    rows = F.array_sort(F.collect_list(F.struct(order, F.coalesce(F.col(headline), F.lit("")).alias("h"))))
    return F.array_join(F.transform(rows, lambda r: r["h"]), C.HEADLINE_SEPARATOR)


def aggregate_day(articles: DataFrame, order: str, weight: str = "News_Impact_Weight") -> DataFrame:
    """One row per company and day from weighted article rows."""
    return articles.groupBy(*DAY).agg(
        *weighted_sums(weight), joined_headlines(order).alias("Headlines"), F.count(F.lit(1)).alias("Article_Count")
    )


def fill_empty_days(df: DataFrame) -> DataFrame:
    """Neutral values for company days without articles, and the topic with the most weight."""
    neutral = {"Sentiment_Score": 0.0, "Sentiment_Positive": 0.0, "Sentiment_Neutral": 1.0, "Sentiment_Negative": 0.0}
    neutral.update(dict.fromkeys(C.TOPIC_COLUMNS, 1.0 / len(C.TOPIC_COLUMNS)))
    filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in neutral.items()}).withColumns(
        {
            "Headlines": F.coalesce("Headlines", F.lit("")),
            "Article_Count": F.coalesce("Article_Count", F.lit(0).cast("bigint")),
        }
    )
    return filled.withColumn(
        "Predicted_Topic", S.arg_max_name(C.TOPIC_COLUMNS, [F.col(c) for c in C.TOPIC_COLUMNS])
    )


def label_days(df: DataFrame, v_ref: str = "Reference_Volatility", params: C.ThresholdParams = C.ThresholdParams()) -> DataFrame:
    threshold = S.adaptive_threshold(F.col("Volatility"), F.col(v_ref), params)
    return df.withColumn("Sentiment_Label", S.sentiment_label(F.col("Sentiment_Score"), threshold))


# --- validation ----------------------------------------------------------------------------


def problems(tolerance: float = C.PROB_SUM_TOLERANCE) -> Column:
    """All validation messages of a daily row; an empty array means the row is valid."""

    def total(cols: Sequence[str]) -> Column:
        out = F.lit(0.0)
        for c in cols:
            out = out + S.safe_float(F.col(c))
        return out

    def off(sum_: Column, what: str) -> Column:
        text = F.format_string(what + " probabilities sum to %.4f, expected ~1.0", sum_)
        return F.when(F.abs(sum_ - 1.0) > tolerance, text)

    probs = ("Sentiment_Positive", "Sentiment_Neutral", "Sentiment_Negative")
    incomplete = F.lit(False)
    for c in probs:
        incomplete = incomplete | F.col(c).isNull()
    score = F.col("Sentiment_Score")
    in_range = F.coalesce(finite(score).between(-1.0, 1.0), F.lit(False))
    messages = [
        F.when(F.coalesce(F.trim("Ticker"), F.lit("")) == "", F.lit("Ticker is missing or blank")),
        off(total(C.TOPIC_COLUMNS), "Topic"),
        F.when(incomplete, F.lit("Sentiment probability columns are missing")).otherwise(off(total(probs), "Sentiment")),
        F.when(score.isNull(), F.lit("Sentiment_Score is missing")).when(
            ~in_range, F.concat(F.lit("Sentiment_Score "), score.cast("string"), F.lit(" is out of range [-1, 1]"))
        ),
        *[
            F.when(F.col(c).isNull() | F.isnan(c), F.lit(f"{c} is missing"))
            for c in ("Open", "High", "Low", "Close")
        ],
    ]
    return F.filter(F.array(*messages), lambda m: m.isNotNull())


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their problems)."""
    checked = df.withColumn("problems", problems())
    return checked.where(F.size("problems") == 0).drop("problems"), checked.where(F.size("problems") > 0)
