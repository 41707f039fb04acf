"""Queries over bars and the trading calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presspulse.config import LOOKBACK_DAYS
from presspulse.functions import market_time as M
from presspulse.operators import market as MK
from presspulse.plans import inputs as I
from presspulse.plans.registry import query, round_all
from presspulse.plans.sql import r, with_views
from presspulse.schemas import OHLCV
from presspulse.sources.storage import new_path, read_or_empty, read_table, write_csv

# fixed values: closed days for the order-date calendar, with one run over several weekdays
ORDER_HOLIDAYS = ("1996-01-26", "1996-12-24", "1996-12-25", "1996-12-26", "1997-08-15", "1998-10-02", "1999-12-31")
_HOLIDAY_SQL = ", ".join(f"date '{h}'" for h in ORDER_HOLIDAYS)


def _bars(spark: SparkSession, folder: str) -> DataFrame:
    return MK.normalize_bars(I.bars(spark, folder))


# prices are quotients of exact inputs and are compared as they are
_OHLCV_SQL = (
    'ticker as "Ticker", bar_date as "Date", open as "Open", high as "High", low as "Low", '
    'close as "Close", close as "Adj_Close", volume as "Volume"'
)


@query("ohlcv_bars", with_views("bars", f"select {_OHLCV_SQL} from bars"))
def ohlcv_bars(spark: SparkSession, folder: str) -> DataFrame:
    return _bars(spark, folder).select("Ticker", "Date", "Open", "High", "Low", "Close", "Adj_Close", "Volume")


@query(
    "ohlcv_lookback",
    with_views(
        "bars",
        f"select {_OHLCV_SQL} from bars where bar_date > (select max(cast(l_shipdate as date)) from lineitem) - 200",
    ),
)
def ohlcv_lookback(spark: SparkSession, folder: str) -> DataFrame:
    as_of = read_table(spark, folder, "lineitem").select(F.max(F.to_date("l_shipdate"))).scalar()
    recent = I.bars(spark, folder, after=F.date_sub(as_of, LOOKBACK_DAYS))
    return MK.lookback(MK.normalize_bars(recent), as_of).select("Ticker", "Date", "Open", "High", "Low", "Close", "Adj_Close", "Volume")


@query("csv_roundtrip", with_views("bars", f"select {_OHLCV_SQL} from bars"))
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "bars-csv")
    before = read_or_empty(spark, path, OHLCV, "csv")
    write_csv(_bars(spark, folder), path)
    stored = before.unionByName(read_or_empty(spark, path, OHLCV, "csv"))
    return stored.select("Ticker", "Date", "Open", "High", "Low", "Close", "Adj_Close", "Volume")


@query(
    "log_returns",
    with_views(
        "bars",
        f"""select ticker as "Ticker", bar_date as "Date",
        {r('ln(close / lag(close) over (partition by ticker order by bar_date))')} as "Log_Return" from bars""",
    ),
)
def log_returns(spark: SparkSession, folder: str) -> DataFrame:
    return MK.add_log_return(_bars(spark, folder)).select("Ticker", "Date", *round_all("Log_Return"))


_VOL_SQL = """
select *, case when count(lr) over w >= 30 then stddev_samp(lr) over w end as vol
from (select *, ln(close / lag(close) over (partition by ticker order by bar_date)) as lr from {bars})
window w as (partition by ticker order by bar_date rows between 89 preceding and current row)"""


@query(
    "rolling_volatility",
    with_views(
        "bars",
        f"""select ticker as "Ticker", bar_date as "Date", {r('vol')} as "Volatility" from ({_VOL_SQL.format(bars='bars')})""",
    ),
)
def rolling_volatility(spark: SparkSession, folder: str) -> DataFrame:
    return MK.add_rolling_volatility(_bars(spark, folder)).select("Ticker", "Date", *round_all("Volatility"))


_ATR_SQL = """
select *, case when count(tr) over w >= 4 then avg(tr) over w end / close as atr
from (select *, greatest(high - low, abs(high - pc), abs(low - pc)) as tr
      from (select *, lag(close) over (partition by ticker order by bar_date) as pc from bars))
window w as (partition by ticker order by bar_date rows between 13 preceding and current row)"""


@query(
    "atr_over_close",
    with_views(
        "bars",
        f"""select ticker as "Ticker", bar_date as "Date", tr as "True_Range", {r('atr')} as "ATR_Over_Close"
        from ({_ATR_SQL})""",
    ),
)
def atr_over_close(spark: SparkSession, folder: str) -> DataFrame:
    return MK.add_atr(_bars(spark, folder)).select("Ticker", "Date", "True_Range", *round_all("ATR_Over_Close"))


@query(
    "latest_volatility",
    with_views(
        "bars",
        f"""select coalesce(v.ticker, a.ticker) as "Ticker", {r('v.vol')} as "Volatility", {r('a.atr')} as "ATR_Over_Close"
        from (select ticker, arg_max(vol, bar_date) as vol from ({_VOL_SQL.format(bars='bars')}) where vol is not null
              group by ticker) v
        full join (select ticker, arg_max(atr, bar_date) as atr from ({_ATR_SQL}) where atr is not null group by ticker) a
        on a.ticker = v.ticker""",
    ),
)
def latest_volatility(spark: SparkSession, folder: str) -> DataFrame:
    both = MK.add_atr(MK.add_rolling_volatility(_bars(spark, folder)))
    last = both.groupBy("Ticker").agg(
        *[
            F.max_by(v, F.when(F.col(v).isNotNull(), F.col("Date"))).alias(v)
            for v in ("Volatility", "ATR_Over_Close")
        ]
    )
    return last.where("Volatility IS NOT NULL OR ATR_Over_Close IS NOT NULL").select(
        "Ticker", *round_all("Volatility", "ATR_Over_Close")
    )


@query(
    "latest_bar",
    with_views(
        "bars",
        f"select {_OHLCV_SQL} from bars qualify row_number() over (partition by ticker order by bar_date desc) = 1",
    ),
)
def latest_bar(spark: SparkSession, folder: str) -> DataFrame:
    return MK.latest_bar(_bars(spark, folder)).select("Ticker", "Date", "Open", "High", "Low", "Close", "Adj_Close", "Volume")


@query(
    "reference_volatility",
    with_views(
        "bars",
        f"""select bar_date as "Date", {r('case when median(vol) > 0 then median(vol) else 0.02::double end')}
        as "Reference_Volatility" from ({_VOL_SQL.format(bars='bars')}) group by bar_date""",
    ),
)
def reference_volatility(spark: SparkSession, folder: str) -> DataFrame:
    vol = MK.add_rolling_volatility(_bars(spark, folder))
    return MK.reference_volatility(vol, "Date").select("Date", *round_all("Reference_Volatility"))


@query(
    "asof_ohlcv",
    with_views(
        "bars_2024 dated_times",
        f"""select g.ticker as "Ticker", g.news_date as "News_Date", b.bar_date as "Bar_Date", b.open as "Open",
        b.close as "Close", b.volume as "Volume"
        from (select distinct ticker, news_date from dated_times) g
        asof left join bars_2024 b on g.ticker = b.ticker and g.news_date >= b.bar_date""",
    ),
)
def asof_ohlcv(spark: SparkSession, folder: str) -> DataFrame:
    """Last bar on or before each company day that has articles."""
    times = I.feed_times(spark, folder)
    days = (
        times.select("Ticker", M.news_date(F.col("Published_At"), I.HOLIDAYS).alias("News_Date"))
        .where("News_Date IS NOT NULL")
        .distinct()
    )
    bars = MK.normalize_bars(I.bars_2024(spark, folder))
    bars = bars.select("Ticker", "Date", F.struct(F.col("Date").alias("Bar_Date"), "Open", "Close", "Volume").alias("Bar"))
    joined = MK.as_of_last(days, bars, ["Ticker"], "News_Date", "Date", ["Bar"])
    return joined.select("Ticker", "News_Date", "Bar.*")


@query(
    "trading_days",
    f"""select d as "Date", isodow(d) > 5 as "Weekend", d in ({_HOLIDAY_SQL}) as "Holiday",
    isodow(d) <= 5 and d not in ({_HOLIDAY_SQL}) as "Trading", count(*) as "Orders"
    from (select cast(o_orderdate as date) as d from orders) group by d""",
)
def trading_days(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per date with the calendar flags of the date."""
    d = F.col("Date")
    return (
        read_table(spark, folder, "orders")
        .groupBy(F.to_date("o_orderdate").alias("Date"))
        .agg(F.count(F.lit(1)).alias("Orders"))
        .select(
            "Date",
            M.is_weekend(d).alias("Weekend"),
            M.is_holiday(d, ORDER_HOLIDAYS).alias("Holiday"),
            M.is_trading_day(d, ORDER_HOLIDAYS).alias("Trading"),
            "Orders",
        )
    )


@query(
    "trading_calendar",
    f"""with days as (
      select cast(unnest(generate_series(date '1980-01-01', date '2030-12-31', interval 1 day)) as date) as d),
    open_days as (
      select d, lag(d) over (order by d) as prev from days where isodow(d) <= 5 and d not in ({_HOLIDAY_SQL}))
    select d as "News_Date", prev as "Previous_Day", prev + interval '8 hours 30 minutes' as "Window_Start",
      d + interval '8 hours 29 minutes 59 seconds' as "Window_End"
    from open_days where d in (select cast(o_orderdate as date) from orders)""",
)
def trading_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """News window of every trading day on which something was ordered."""
    d = F.col("News_Date")
    return (
        read_table(spark, folder, "orders")
        .select(F.to_date("o_orderdate").alias("News_Date"))
        .distinct()
        .where(M.is_trading_day(d, ORDER_HOLIDAYS))
        .select(
            "News_Date",
            M.previous_trading_day(d, ORDER_HOLIDAYS).alias("Previous_Day"),
            M.window_start(d, ORDER_HOLIDAYS).alias("Window_Start"),
            M.window_end(d).alias("Window_End"),
        )
    )
