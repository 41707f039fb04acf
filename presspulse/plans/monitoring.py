"""Accuracy of stored predictions, measured by day: only days whose tables have changed are measured again.

Below ``{root}/accuracy/horizon=<h>``: ``parts``, one row a ticker, model, target and day, replaced by day; and
``seen``, which says which folder of each table every day was measured from. ``seen`` is written last, so a job
that fails measures its days again. One job at a time measures a horizon.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presspulse.operators import features as FE
from presspulse.operators import forecast as FC
from presspulse.schemas import ACCURACY_PARTS, DAILY, PREDICTIONS
from presspulse.sources import storage as ST

GROUP = ["Ticker", "Model_Name", "Target"]
SEEN = "table string, day date, folder string"


def _day_table(spark: SparkSession, days: Iterable[date]) -> DataFrame:
    return ST.broadcast_if_small(spark.createDataFrame([(d,) for d in sorted(days)], "News_Date date"))


def days_before(daily: DataFrame, changed: set[date]) -> set[date]:
    """Days of rows whose next session lies on a changed day, or did so before the change."""
    near = FE.with_lookback(daily.select("Ticker", "News_Date"), min(changed), rows=1)
    following = F.lead("News_Date").over(Window.partitionBy("Ticker").orderBy("News_Date"))
    dates = F.split(F.lit(",".join(d.isoformat() for d in sorted(changed))), ",").cast("array<date>")
    hit = F.exists(dates, lambda d: (d > F.col("News_Date")) & (F.col("next").isNull() | (d <= F.col("next"))))
    found = near.withColumn("next", following).where(hit).select("News_Date").distinct()
    return {r["News_Date"] for r in found.collect()}  # a row a day


def measure_changed_days(spark: SparkSession, root: str, horizon: int = 0) -> tuple[DataFrame, DataFrame]:
    """Bring the parts up to date; returns them and the groups of which some day was measured."""
    path = f"{root}/accuracy/horizon={horizon}"
    now = {(t, d, f) for t in ("predictions", "daily") for d, f in ST.day_folders(spark, f"{root}/{t}").items()}
    last = ST.newest_finished(spark, f"{path}/seen")
    seen = {tuple(r) for r in spark.read.schema(SEEN).parquet(last).collect()} if last else set()
    days = {d for _, d, _ in now ^ seen}
    moved = {d for t, d, _ in now ^ seen if t == "daily"}
    if horizon and seen and moved:
        days |= days_before(ST.read_range_table(spark, f"{root}/daily", DAILY), moved)
    if not days:
        nothing = spark.createDataFrame([], ACCURACY_PARTS)
        return ST.read_range_table(spark, f"{path}/parts", ACCURACY_PARTS), nothing.select(GROUP)

    first, last_day = min(days), max(days)
    chosen = _day_table(spark, days)
    predictions = ST.read_range_table(spark, f"{root}/predictions", PREDICTIONS, start=first, end=last_day)
    daily = ST.read_range_table(spark, f"{root}/daily", DAILY, start=first, end=None if horizon else last_day)
    actuals = FC.melt_actuals(FC.next_session(daily) if horizon else daily)
    if horizon:
        actuals = actuals.where("Actual_Value IS NOT NULL")
    joined = FC.with_actuals(predictions.join(chosen, "News_Date", "left_semi"), actuals)
    parts = ST.cut_lineage(FC.accuracy_parts(joined))
    stored = ST.read_range_table(spark, f"{path}/parts", ACCURACY_PARTS, start=first, end=last_day)
    touched = parts.select(GROUP).unionByName(stored.join(chosen, "News_Date", "left_semi").select(GROUP)).distinct()
    touched = ST.cut_lineage(touched)
    others = stored.join(chosen, "News_Date", "left_anti").select(ACCURACY_PARTS.fieldNames())
    whole = parts.select(ACCURACY_PARTS.fieldNames()).unionByName(others).repartition("News_Date")
    ST.replace_range(whole, f"{path}/parts", ACCURACY_PARTS, first, last_day)
    ST.write_next(spark.createDataFrame(sorted(now), SEEN), f"{path}/seen")
    return ST.read_range_table(spark, f"{path}/parts", ACCURACY_PARTS), touched
