"""Price models in long form, scaling, and realised accuracy."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions.isolation import score_rows
from presspulse.functions.scoring import sanitize_price
from presspulse.schemas import finite

# A model is a column of raw price values; NULL means the model gave no result for the row.
Model = Callable[[DataFrame], Column]


def predict_long(df: DataFrame, models: Sequence[tuple[C.ModelSpec, Column]], keys: Sequence[str]) -> DataFrame:
    """One row per input row and model result, clamped around the last close.

    All models are columns of one pass over the features and are stacked afterwards, so features
    are computed once. A model without a result (NULL or not finite) yields no row and does not
    disturb the others.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(s.name).alias("Model_Name"),
                F.lit(s.backend).alias("Backend"),
                F.lit(s.target).alias("Target"),
                F.lit(s.unverified).alias("Unverified"),
                finite(raw.cast("double")).alias("Raw_Predicted_Value"),
            )
            for s, raw in models
        ]
    )
    long = df.select(*keys, F.col("Close").alias("Last_Close"), F.inline(entries))
    return long.where(F.col("Raw_Predicted_Value").isNotNull()).withColumn(
        "Predicted_Value", sanitize_price(F.col("Raw_Predicted_Value"), F.col("Last_Close"))
    )


def clamped_only(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.col("Raw_Predicted_Value") != F.col("Predicted_Value"))


def batch_price_model(
    predict: Callable[[np.ndarray], np.ndarray],
    target_scale: Sequence[tuple[float, float]] | None = None,
    output_index: int | None = None,
    steps: int | None = None,
) -> Callable[[Column], Column]:
    """Wrap an external model as a vectorised UDF over a feature array column.

    ``predict`` takes one batch, rows by features, and returns one value or one vector per row. With
    ``steps`` the column is an array of that many feature rows and a batch has three dimensions; it
    travels flat, which transfers much faster than nested arrays. The target scaling is
    undone on the whole vector before one output is picked. Rows for which the model fails alone
    give NULL and then yield no prediction; the other rows of their batch are scored without them.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            values = rows.to_list()

            def run(part: slice) -> np.ndarray:
                x = np.stack(values[part]).astype("float64")
                if steps is not None:
                    x = x.reshape(len(x), steps, -1)
                out = np.asarray(predict(x), dtype="float64").reshape(len(x), -1)
                if target_scale is not None:
                    mean, scale = np.array(target_scale, dtype="float64").T
                    out = out * scale + mean
                return out[:, output_index or 0]

            yield pd.Series(score_rows(run, len(values), 1)[0][:, 0])

    return score if steps is None else lambda column: score(F.flatten(column))


# --- scaling ---------------------------------------------------------------------------------


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column, one row per column; a zero deviation scales by 1."""
    aggs = []
    for c in columns:
        std = F.stddev_pop(c)
        aggs.append(
            F.struct(
                F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.when(std > 0, std).otherwise(1.0).alias("scale")
            )
        )
    return df.agg(F.array(*aggs).alias("s")).select(F.inline("s"))


def scaler_values(stats: DataFrame) -> dict[str, tuple[float, float]]:
    """Fitted values on the driver: one (mean, scale) per feature column."""
    return {r["feature"]: (r["mean"], r["scale"]) for r in stats.collect()}


def standardize(c: Column, mean: float, scale: float) -> Column:
    return (c - F.lit(mean)) / F.lit(scale)


def unstandardize(c: Column, mean: float, scale: float) -> Column:
    return c * F.lit(scale) + F.lit(mean)


# --- monitoring --------------------------------------------------------------------------------


def melt_actuals(daily: DataFrame) -> DataFrame:
    return daily.select("Ticker", "News_Date", "Open", "Close").unpivot(
        ["Ticker", "News_Date"], ["Open", "Close"], "Target", "Actual_Value"
    )


def next_session(daily: DataFrame) -> DataFrame:
    """Each day's row carrying the following session's Open and Close."""
    w = Window.partitionBy("Ticker").orderBy("News_Date")
    return daily.select(
        "Ticker", "News_Date", F.lead("Open").over(w).alias("Open"), F.lead("Close").over(w).alias("Close")
    ).where(F.col("Open").isNotNull() | F.col("Close").isNotNull())


def with_actuals(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Predictions joined to realised values; a stale value column is replaced."""
    return predictions.drop("Actual_Value").join(actuals, ["Ticker", "News_Date", "Target"])


def accuracy(joined: DataFrame, keys: Sequence[str] = ("Ticker", "Model_Name", "Target")) -> DataFrame:
    """Error metrics per group in a single pre-aggregated pass.

    A group with any missing input yields no row. R2 of constant actuals is 1 for a perfect fit
    and 0 otherwise; groups of one have none. MAPE is over non-zero actuals.
    """
    a, p, prev = (finite(F.col(c)) for c in ("Actual_Value", "Predicted_Value", "Last_Close"))
    err = a - p
    complete = a.isNotNull() & p.isNotNull() & prev.isNotNull()
    sums = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("N_Samples"),
        F.count_if(~complete).alias("bad"),
        F.avg(F.abs(err)).alias("MAE"),
        F.sqrt(F.avg(err * err)).alias("RMSE"),
        (F.avg(F.when(a != 0, F.abs(F.try_divide(err, a)))) * 100.0).alias("MAPE"),
        F.sum(err * err).alias("sse"),
        (F.var_pop(a) * F.count(F.lit(1))).alias("sst"),
        (F.max(a) == F.min(a)).alias("flat"),
        F.avg((F.signum(a - prev) == F.signum(p - prev)).cast("double")).alias("Direction_Accuracy"),
    )
    r2 = F.when(F.col("N_Samples") < 2, None).when(
        F.col("flat"), F.when(F.col("sse") == 0, 1.0).otherwise(0.0)
    ).otherwise(1.0 - F.try_divide(F.col("sse"), F.col("sst")))
    return sums.where("bad = 0").select(*keys, "N_Samples", "MAE", "RMSE", "MAPE", r2.alias("R2"), "Direction_Accuracy")


def accuracy_parts(joined: DataFrame, keys: Sequence[str] = ("Ticker", "Model_Name", "Target", "News_Date")) -> DataFrame:
    """What ``merged_accuracy`` needs of each group: counts, sums, and mean and squared deviations of the actuals."""
    a, p, prev = (finite(F.col(c)) for c in ("Actual_Value", "Predicted_Value", "Last_Close"))
    err = a - p
    ratio = F.when(a != 0, F.abs(F.try_divide(err, a)))
    return joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(a.isNull() | p.isNull() | prev.isNull()).alias("n_missing"),
        F.sum(F.abs(err)).alias("abs_error"),
        F.sum(err * err).alias("sq_error"),
        F.count(ratio).alias("n_ratio"),
        F.sum(ratio).alias("ratio"),
        F.avg(a).alias("mean"),
        (F.var_pop(a) * F.count(a)).alias("spread"),
        F.min(a).alias("low"),
        F.max(a).alias("high"),
        F.count_if(F.signum(a - prev) == F.signum(p - prev)).alias("hits"),
    )


def merged_accuracy(parts: DataFrame, keys: Sequence[str] = ("Ticker", "Model_Name", "Target")) -> DataFrame:
    """The metrics of ``accuracy`` from the parts of any division of the rows.

    Squared deviations add up within and between parts, about the common mean, which loses no digits as sums of
    squares would.
    """
    n = F.sum("n")
    sums = parts.groupBy(*keys).agg(
        n.alias("N_Samples"),
        F.sum("n_missing").alias("missing"),
        (F.sum("abs_error") / n).alias("MAE"),
        F.sqrt(F.sum("sq_error") / n).alias("RMSE"),
        (F.try_divide(F.sum("ratio"), F.sum("n_ratio")) * 100.0).alias("MAPE"),
        F.sum("sq_error").alias("sse"),
        F.sum("spread").alias("within"),
        (F.max("high") == F.min("low")).alias("flat"),
        (F.sum(F.col("n") * F.col("mean")) / n).alias("center"),
        (F.sum("hits") / n).alias("Direction_Accuracy"),
    )
    sums = sums.where("missing = 0")
    off = F.col("mean") - F.col("center")
    between = parts.join(sums.select(*keys, "center"), list(keys)).groupBy(*keys).agg(F.sum(F.col("n") * off * off).alias("between"))
    sst = F.col("within") + F.col("between")
    r2 = F.when(F.col("N_Samples") < 2, None).when(
        F.col("flat"), F.when(F.col("sse") == 0, 1.0).otherwise(0.0)
    ).otherwise(1.0 - F.try_divide(F.col("sse"), sst))
    return sums.join(between, list(keys)).select(*keys, "N_Samples", "MAE", "RMSE", "MAPE", r2.alias("R2"), "Direction_Accuracy")


def alerts(perf: DataFrame, mape: float = C.MAPE_ALERT, direction: float = C.DIRECTION_ALERT) -> DataFrame:
    """Groups that breach a threshold, with the reasons; a missing metric never alerts."""
    reasons = F.filter(
        F.array(
            F.when(F.col("MAPE") > mape, F.lit("MAPE above threshold")),
            F.when(F.col("Direction_Accuracy") < direction, F.lit("Direction accuracy below threshold")),
        ),
        lambda r: r.isNotNull(),
    )
    return perf.withColumn("reasons", reasons).where(F.size("reasons") > 0)
