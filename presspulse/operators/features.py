"""Feature tables for the price models, computed for all tickers and days at once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions import market_time as M
from presspulse.functions.scoring import safe_float
from presspulse.operators.market import guarded, log_return
from presspulse.sources.storage import cut_lineage

# Earlier rows of a ticker that a row's features and their sequence read: the sequence's own, and a week of
# returns before its first one.
LOOKBACK_ROWS = C.SEQUENCE_LENGTH - 1 + 7


def ticker_codes(companies: DataFrame) -> DataFrame:
    """Alphabetical rank from 0, for any number of listings; no job runs while the plan is built.

    Tickers are ranked among those with the same first two characters, and the numbers of tickers of earlier
    beginnings are added. Only these numbers, one a beginning, go through one task.
    """
    distinct = companies.select("ticker", F.substring("ticker", 1, 2).alias("__start")).distinct()
    earlier = Window.orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    starts = distinct.groupBy("__start").agg(F.count(F.lit(1)).alias("__n"))
    before = starts.select(F.col("__start").alias("__of"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("__start").orderBy("ticker")) - 1
    ranked = distinct.withColumn("__rank", rank).join(before, F.col("__start").eqNullSafe(F.col("__of")))
    return ranked.select("ticker", (F.col("__rank") + F.col("__before")).cast("int").alias("Ticker_Code"))


def with_lookback(history: DataFrame, start: Date, rows: int = LOOKBACK_ROWS, date: str = "News_Date") -> DataFrame:
    """The rows from ``start`` on, and as many earlier ones of each ticker as their windows read, however far
    back in time those lie.

    Only ticker and day are read to find each ticker's ``rows``-th newest day before ``start``; a limit on a
    rank keeps that many rows a ticker ahead of the shuffle. The oldest of these days limits the scan.
    """
    before = history.where(F.col(date) < F.lit(start)).select("Ticker", date)
    w = Window.partitionBy("Ticker").orderBy(F.desc(date))
    newest = before.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= rows)
    since = cut_lineage(newest.groupBy("Ticker").agg(F.min(date).alias("__since")))
    oldest = since.agg(F.min("__since")).scalar()
    scan = history.where(F.col(date) >= F.coalesce(oldest, F.lit(start)))
    return scan.join(since, "Ticker", "left").where(F.col(date) >= F.coalesce("__since", F.lit(start))).drop("__since")


def intraday_pct(open_: Column, close: Column) -> Column:
    return F.coalesce(F.try_divide(close - open_, open_) * 100.0, F.lit(0.0))


def range_pct(high: Column, low: Column, close: Column) -> Column:
    return F.coalesce(F.try_divide(high - low, close) * 100.0, F.lit(0.0))


def log_volume(volume: Column) -> Column:
    return F.log1p(F.greatest(F.lit(0.0), F.coalesce(volume, F.lit(0.0))))


def add_sentiment_means(df: DataFrame, date: str = "News_Date") -> DataFrame:
    w = Window.partitionBy("Ticker").orderBy(date)
    return df.withColumns(
        {f"Sentiment_RollMean_{n}": F.avg("Sentiment_Score").over(w.rowsBetween(1 - n, 0)) for n in (3, 7)}
    )


def add_momentum_means(df: DataFrame, date: str = "News_Date") -> DataFrame:
    w = Window.partitionBy("Ticker").orderBy(date)
    prev = F.lag("Close").over(w)
    change = F.coalesce(F.try_divide(F.col("Close") - prev, prev), F.lit(0.0)) * 100.0
    return df.withColumn("Daily_Return", change).withColumns(
        {f"Momentum_RollMean_{n}": F.avg("Daily_Return").over(w.rowsBetween(1 - n, 0)) for n in (3, 7)}
    )


def add_short_volatility(df: DataFrame, date: str = "News_Date") -> DataFrame:
    w = Window.partitionBy("Ticker").orderBy(date)
    frame = w.rowsBetween(-6, 0)
    lr = F.col("__lr")
    std = guarded(F.stddev_samp(lr).over(frame), lr, frame, 2)
    return (
        df.withColumn("__lr", log_return(F.col("Close"), w))
        .withColumn("Volatility_Roll7", F.coalesce(std, F.lit(0.0)))
        .drop("__lr")
    )


def engineered(
    daily: DataFrame, codes: DataFrame, date: str = "News_Date", keep: Sequence[str] = ()
) -> DataFrame:
    """The 20 rolling-history features of every ticker and day, missing values filled with 0.

    ``keep`` names input columns to carry along, so that other feature families can be added to
    the same rows without a join.
    """
    df = add_short_volatility(add_momentum_means(add_sentiment_means(daily, date), date), date)
    month_sin, month_cos = M.cyclical(F.month(date), 12)
    dow_sin, dow_cos = M.cyclical(F.weekday(date), 7)
    df = df.withColumns(
        {
            "NewsDay_Intraday_Pct": intraday_pct(F.col("Open"), F.col("Close")),
            "NewsDay_Range_Pct": range_pct(F.col("High"), F.col("Low"), F.col("Close")),
            "Log_Volume": log_volume(F.col("Volume")),
            "Month_sin": month_sin,
            "Month_cos": month_cos,
            "DOW_sin": dow_sin,
            "DOW_cos": dow_cos,
        }
    )
    df = df.join(codes.withColumnRenamed("ticker", "Ticker"), "Ticker", "left")
    df = df.withColumn("Ticker_Code", F.coalesce("Ticker_Code", F.lit(-1)))
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in C.ENGINEERED_COLUMNS]
    return df.select("Ticker", date, *keep, *filled)


def same_day_columns() -> dict[str, Column]:
    """The 14 same-day features as expressions over a daily row."""
    o, h, l, c = (safe_float(F.col(x)) for x in ("Open", "High", "Low", "Close"))
    return {
        "News_Day_Open": o,
        "News_Day_High": h,
        "News_Day_Low": l,
        "News_Day_Close": c,
        "News_Day_Volume": safe_float(F.col("Volume")),
        "Day_High_Low_Spread_Pct": range_pct(h, l, c),
        "Day_Close_Open_Spread_Pct": intraday_pct(o, c),
        **{x: safe_float(F.col(x)) for x in ("Sentiment_Score", *C.TOPIC_COLUMNS)},
    }


def same_day(daily: DataFrame, date: str = "News_Date") -> DataFrame:
    return daily.select("Ticker", date, *[c.alias(n) for n, c in same_day_columns().items()])


def feature_vector(df: DataFrame, name: str, out: str = "features") -> DataFrame:
    """One array column holding a named feature set in its fixed order."""
    return df.withColumn(out, F.array(*[F.col(c) for c in C.FEATURE_SETS[name]]))


def latest_rows(df: DataFrame, date: str = "News_Date") -> DataFrame:
    rest = [c for c in df.columns if c != "Ticker"]
    return df.groupBy("Ticker").agg(F.max_by(F.struct(*rest), date).alias("r")).select("Ticker", "r.*")


def add_sequence(
    features: DataFrame, columns: Sequence[str], out: str, length: int = C.SEQUENCE_LENGTH, date: str = "News_Date"
) -> DataFrame:
    """The last ``length`` feature rows up to each day, the earliest one repeated in front."""
    w = Window.partitionBy("Ticker").orderBy(date).rowsBetween(1 - length, 0)
    seq = F.collect_list(F.array(*[F.col(c) for c in columns])).over(w)
    padded = F.concat(F.array_repeat(F.get(out, F.lit(0)), F.lit(length) - F.size(out)), F.col(out))
    return features.withColumn(out, seq).withColumn(out, padded)


def sequences(
    features: DataFrame, columns: Sequence[str], length: int = C.SEQUENCE_LENGTH, date: str = "News_Date"
) -> DataFrame:
    return add_sequence(features, columns, "seq", length, date).select("Ticker", date, "seq")
