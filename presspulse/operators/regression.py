"""Trained price models: scale, reduce, regress, one model per target; stored and loaded as rows of a registry."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions.scoring import safe_float
from presspulse.operators import forecast as FC
from presspulse.schemas import PRICE_MODELS, conform
from presspulse.sources.storage import append_rows, claim_version, cut_lineage, read_or_empty

TARGETS = ("Open", "Close")


def next_day_targets(daily: DataFrame) -> DataFrame:
    """Daily rows with the following session's prices as ``Next_Open`` and ``Next_Close``."""
    w = Window.partitionBy("Ticker").orderBy("News_Date")
    return daily.withColumns({f"Next_{t}": F.lead(t).over(w) for t in TARGETS})


def scaled(df: DataFrame, columns: Sequence[str], fit: dict[str, tuple[float, float]]) -> DataFrame:
    """Missing values become 0, then every column is standardised."""
    return df.withColumns({f"z_{c}": FC.standardize(safe_float(F.col(c)), *fit[c]) for c in columns})


def train(daily: DataFrame, columns: Sequence[str] = tuple(C.REGRESSION_COLUMNS), components: int = C.PCA_COMPONENTS):
    """Fit the scaler, the reduction and one regression per target on all rows with a next session.

    The fit runs distributed; only means, deviations, the component matrix and the coefficients
    reach the driver.
    """
    known = next_day_targets(daily).where(" AND ".join(f"Next_{t} IS NOT NULL" for t in TARGETS))
    # read by several passes, so it is computed once; a daily table is small next to its sources
    clean = cut_lineage(
        known.select(*[safe_float(F.col(c)).alias(c) for c in columns], *[f"Next_{t}" for t in TARGETS])
    )
    fit = FC.scaler_values(FC.fit_scaler(clean, columns))
    z = scaled(clean, columns, fit)
    stages = [
        VectorAssembler(inputCols=[f"z_{c}" for c in columns], outputCol="z"),
        PCA(k=min(components, len(columns)), inputCol="z", outputCol="components"),
        *[
            LinearRegression(featuresCol="components", labelCol=f"Next_{t}", predictionCol=f"Predicted_{t}")
            for t in TARGETS
        ],
    ]
    return fit, Pipeline(stages=stages).fit(z)


def predict(daily: DataFrame, fit: dict[str, tuple[float, float]], model: PipelineModel) -> DataFrame:
    """Raw predictions per row as ``Predicted_Open`` and ``Predicted_Close``."""
    out = model.transform(scaled(daily, list(fit), fit))
    return out.drop("z", "components", *[f"z_{c}" for c in fit])


def store_models(spark: SparkSession, path: str, name: str, fit: dict[str, tuple[float, float]], model: PipelineModel, rows: int) -> int:
    """Add a fitted chain to the registry at ``path`` as the next version of ``name``; returns the version.

    Reduction and regression are linear, so a row a target holds all of the chain: the scaling, one weight a
    column and the intercept. The rows are published together.
    """
    columns = list(fit)
    components = model.stages[1].pc.toArray()
    version = claim_version(spark, f"{path}/{name}")
    held = []
    for target, line in zip(TARGETS, model.stages[2:], strict=True):
        weights = [float(w) for w in components @ line.coefficients.toArray()]
        scale = [[float(fit[c][i]) for c in columns] for i in (0, 1)]
        held.append((name, version, target, columns, *scale, weights, float(line.intercept), rows, None))
    table = spark.createDataFrame(held, PRICE_MODELS).withColumn("trained_at", F.current_timestamp())
    append_rows(conform(table, PRICE_MODELS).coalesce(1), f"{path}/registry", PRICE_MODELS, partition=None)
    return version


def stored_models(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> list[tuple[C.ModelSpec, Callable[[DataFrame], Column]]]:
    """The newest version of the named models (of all, by default) as columns over feature rows."""
    registry = read_or_empty(spark, f"{path}/registry", PRICE_MODELS)
    whole = F.struct(*PRICE_MODELS.fieldNames())
    newest = registry.groupBy("name", "target").agg(F.max_by(whole, "version").alias("m")).select("m.*").collect()  # a row a model
    missing = set(names or ()) - {r["name"] for r in newest}
    if missing:
        raise ValueError(f"no stored model {', '.join(sorted(missing))} in {path}")

    def price(row) -> Callable[[DataFrame], Column]:
        def raw(_: DataFrame) -> Column:
            total = F.lit(row["intercept"])
            for c, mean, std, weight in zip(row["columns"], row["mean"], row["std"], row["weights"], strict=True):
                total += FC.standardize(safe_float(F.col(c)), mean, std) * weight
            return total

        return raw

    chosen = sorted((r for r in newest if names is None or r["name"] in names), key=lambda r: (r["name"], r["target"]))
    return [(C.ModelSpec(r["name"], r["target"], "spark_ml", f"version {r['version']}"), price(r)) for r in chosen]
