"""Operators over daily bars.

Bars are unique per (ticker, day), so a ticker's window holds at most one row per calendar day
however large the feed is. Windows of one operator share a specification and sort once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.schemas import OHLCV, conform, finite


def by_ticker(date: str = "Date", ticker: str = "Ticker") -> WindowSpec:
    return Window.partitionBy(ticker).orderBy(date)


def normalize_bars(df: DataFrame) -> DataFrame:
    """Any bar table to the standard columns: NaN becomes NULL, adjusted close defaults to close."""
    if "Adj Close" in df.columns:
        df = df.withColumnRenamed("Adj Close", "Adj_Close")
    if "Adj_Close" not in df.columns and "Close" in df.columns:
        df = df.withColumn("Adj_Close", F.col("Close"))
    df = conform(df, OHLCV)
    return df.select("Ticker", "Date", *[finite(F.col(f.name)).alias(f.name) for f in OHLCV.fields[2:]])


def lookback(df: DataFrame, as_of: Column, days: int = C.LOOKBACK_DAYS, date: str = "Date") -> DataFrame:
    """Bars of the last ``days`` days; the range reaches the scan as a pushed filter."""
    return df.where((F.col(date) > F.date_sub(as_of, days)) & (F.col(date) <= as_of))


def log_return(close: Column, w: WindowSpec) -> Column:
    return F.ln(F.try_divide(close, F.lag(close).over(w)))


def guarded(value: Column, over: Column, frame: WindowSpec, least: int) -> Column:
    """A windowed value, NULL until ``least`` non-null inputs are in the frame."""
    return F.when(F.count(over).over(frame) >= least, value)


def add_log_return(df: DataFrame, date: str = "Date", close: str = "Close") -> DataFrame:
    return df.withColumn("Log_Return", log_return(F.col(close), by_ticker(date)))


def add_rolling_volatility(
    df: DataFrame, window: int = C.VOLATILITY_WINDOW, date: str = "Date", close: str = "Close"
) -> DataFrame:
    """Sample deviation of log returns over ``window`` rows, from a third of them upwards."""
    frame = by_ticker(date).rowsBetween(1 - window, 0)
    lr = F.col("Log_Return")
    return add_log_return(df, date, close).withColumn(
        "Volatility", guarded(F.stddev_samp(lr).over(frame), lr, frame, max(2, window // 3))
    )


def add_atr(df: DataFrame, window: int = C.ATR_WINDOW, date: str = "Date") -> DataFrame:
    """Average true range divided by the close."""
    w = by_ticker(date)
    frame = w.rowsBetween(1 - window, 0)
    prev = F.lag("Close").over(w)
    spans = F.greatest(F.col("High") - F.col("Low"), F.abs(F.col("High") - prev), F.abs(F.col("Low") - prev))
    tr = F.col("True_Range")
    mean = guarded(F.avg(tr).over(frame), tr, frame, max(2, window // 3))
    return df.withColumn("True_Range", spans).withColumn("ATR_Over_Close", F.try_divide(mean, F.col("Close")))


def latest_value(df: DataFrame, value: str, date: str = "Date", ticker: str = "Ticker") -> DataFrame:
    """Last non-null value per ticker, pre-aggregated before the shuffle."""
    return df.where(F.col(value).isNotNull()).groupBy(ticker).agg(F.max_by(value, date).alias(value))


def latest_bar(df: DataFrame, date: str = "Date", ticker: str = "Ticker") -> DataFrame:
    rest = [c for c in df.columns if c != ticker]
    return df.groupBy(ticker).agg(F.max_by(F.struct(*rest), date).alias("b")).select(ticker, "b.*")


def as_of_last(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, values: Sequence[str]
) -> DataFrame:
    """Attach to each left row, per value column, the last non-null value at or before its time.

    Both sides are stacked and carried forward in one window per key: one shuffle, no range join.
    Both sides hold one row per key and day, which bounds the window.
    """
    w = Window.partitionBy(*keys).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    extra = [c for c in left.columns if c not in keys]
    tagged = left.select(
        *keys, F.col(left_time).alias("__t"), F.lit(1).alias("__side"), F.struct(*extra).alias("__left")
    ).unionByName(
        right.select(*keys, F.col(right_time).alias("__t"), F.lit(0).alias("__side"), *values),
        allowMissingColumns=True,
    )
    carried = tagged.withColumns({v: F.last(v, ignorenulls=True).over(w) for v in values})
    return carried.where("__side = 1").select(*keys, "__left.*", *values)


def add_reference_volatility(df: DataFrame, day: str, vol: str = "Volatility") -> DataFrame:
    """Exact median over the universe on each day; none or not positive gives the default.

    The medians are a group-by of two narrow columns that is joined back, so wide rows are not
    gathered by day.
    """
    return df.join(reference_volatility(df, day, vol), day, "left")


def reference_volatility(df: DataFrame, day: str, vol: str = "Volatility") -> DataFrame:
    """The same median as one row per day."""
    med = F.median(F.col(vol))
    return df.groupBy(day).agg(
        F.coalesce(F.when(med > 0, med), F.lit(C.DEFAULT_V_REF)).alias("Reference_Volatility")
    )
