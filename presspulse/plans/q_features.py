"""Queries over model features and scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions import market_time as M
from presspulse.operators import features as FE
from presspulse.operators import forecast as FC
from presspulse.plans import inputs as I
from presspulse.plans.registry import query, round_all, rounded
from presspulse.plans.sql import r, with_views
from presspulse.sources.storage import read_table

_T = [f"t{i}" for i in range(1, 7)]
_KEY = 'ticker as "Ticker", news_date as "News_Date"'

_MEANS = """avg(score) over (w rows between {n} preceding and current row)"""

# All engineered features; Brand#5 is unknown to the code table.
_FEATURES = [
    (
        "steps",
        """
  select *, lag(close) over (partition by ticker order by news_date) as pc from history""",
    ),
    (
        "moves",
        """select *, ln(close / pc) as lr, coalesce((close - pc) / pc, 0.0::double) * 100.0 as ret from steps""",
    ),
    (
        "codes",
        """
  select ticker, row_number() over (order by ticker) - 1 as code from (select distinct p_brand as ticker from part)
  where ticker <> 'Brand#5'""",
    ),
    (
        "engineered",
        """
  select m.*, coalesce((close - open) / nullif(open, 0) * 100.0, 0.0::double) as intraday,
    coalesce((high - low) / nullif(close, 0) * 100.0, 0.0::double) as rng, ln(1 + greatest(0.0::double, volume)) as logvol,
    sin(2 * pi() * (month(news_date) / 12.0::double)) as msin, cos(2 * pi() * (month(news_date) / 12.0::double)) as mcos,
    sin(2 * pi() * ((isodow(news_date) - 1) / 7.0::double)) as dsin, cos(2 * pi() * ((isodow(news_date) - 1) / 7.0::double)) as dcos,
    avg(score) over w3 as s3, avg(score) over w7 as s7, avg(ret) over w3 as m3, avg(ret) over w7 as m7,
    coalesce(case when count(lr) over w7 >= 2 then stddev_samp(lr) over w7 end, 0.0::double) as v7,
    cast(coalesce(c.code, -1) as double) as code
  from moves m left join codes c using (ticker)
  window w3 as (partition by ticker order by news_date rows between 2 preceding and current row),
         w7 as (partition by ticker order by news_date rows between 6 preceding and current row)""",
    ),
]
_ENG_SQL = dict(
    zip(
        C.ENGINEERED_COLUMNS,
        ["score", *_T, "intraday", "rng", "logvol", "msin", "mcos", "dsin", "dcos", "s3", "s7", "m3", "m7", "v7", "code"],
    )
)


def _codes(spark: SparkSession, folder: str) -> DataFrame:
    return FE.ticker_codes(I.companies(spark, folder).where("ticker <> 'Brand#5'"))


def _engineered(spark: SparkSession, folder: str) -> DataFrame:
    return FE.engineered(I.history(spark, folder), _codes(spark, folder))


@query(
    "ticker_codes",
    """with c as (select ticker, row_number() over (order by ticker) - 1 as code from (select distinct p_brand as ticker from part)
      where ticker <> 'Brand#5')
    select t.ticker as "Ticker", coalesce(c.code, -1) as "Ticker_Code", t.n as "Parts"
    from (select p_brand as ticker, count(*) as n from part group by 1) t left join c using (ticker)""",
)
def ticker_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Alphabetical codes of the known companies; an unknown ticker has code -1."""
    parts = read_table(spark, folder, "part").groupBy(F.col("p_brand").alias("ticker")).agg(F.count(F.lit(1)).alias("Parts"))
    coded = parts.join(_codes(spark, folder), "ticker", "left")
    return coded.select(
        F.col("ticker").alias("Ticker"), F.coalesce("Ticker_Code", F.lit(-1)).cast("bigint").alias("Ticker_Code"), "Parts"
    )


@query(
    "cyclical_features",
    f"""select o_orderkey, {r("sin(2 * pi() * (month(o_orderdate) / 12.0::double))")} as "Month_sin",
    {r("cos(2 * pi() * (month(o_orderdate) / 12.0::double))")} as "Month_cos",
    {r("sin(2 * pi() * ((isodow(o_orderdate) - 1) / 7.0::double))")} as "DOW_sin",
    {r("cos(2 * pi() * ((isodow(o_orderdate) - 1) / 7.0::double))")} as "DOW_cos" from orders""",
)
def cyclical_features(spark: SparkSession, folder: str) -> DataFrame:
    month_sin, month_cos = M.cyclical(F.month("o_orderdate"), 12)
    dow_sin, dow_cos = M.cyclical(F.weekday("o_orderdate"), 7)
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        rounded(month_sin).alias("Month_sin"),
        rounded(month_cos).alias("Month_cos"),
        rounded(dow_sin).alias("DOW_sin"),
        rounded(dow_cos).alias("DOW_cos"),
    )


@query(
    "sentiment_rollmeans",
    with_views(
        "history",
        f"""select {_KEY}, {r(_MEANS.format(n=2))} as "Sentiment_RollMean_3", {r(_MEANS.format(n=6))} as "Sentiment_RollMean_7"
        from history window w as (partition by ticker order by news_date)""",
    ),
)
def sentiment_rollmeans(spark: SparkSession, folder: str) -> DataFrame:
    df = FE.add_sentiment_means(I.history(spark, folder))
    return df.select("Ticker", "News_Date", *round_all("Sentiment_RollMean_3", "Sentiment_RollMean_7"))


@query(
    "momentum_rollmeans",
    with_views(
        "history",
        f"""select {_KEY}, {r('m3')} as "Momentum_RollMean_3", {r('m7')} as "Momentum_RollMean_7" from engineered""",
        _FEATURES,
    ),
)
def momentum_rollmeans(spark: SparkSession, folder: str) -> DataFrame:
    df = FE.add_momentum_means(I.history(spark, folder))
    return df.select("Ticker", "News_Date", *round_all("Momentum_RollMean_3", "Momentum_RollMean_7"))


@query(
    "volatility_roll7",
    with_views("history", f"""select {_KEY}, {r('v7')} as "Volatility_Roll7" from engineered""", _FEATURES),
)
def volatility_roll7(spark: SparkSession, folder: str) -> DataFrame:
    df = FE.add_short_volatility(I.history(spark, folder))
    return df.select("Ticker", "News_Date", *round_all("Volatility_Roll7"))


_ENG_SELECT = ", ".join(f'{r(v)} as "{k}"' for k, v in _ENG_SQL.items())


@query("engineered_features", with_views("history", f"select {_KEY}, {_ENG_SELECT} from engineered", _FEATURES))
def engineered_features(spark: SparkSession, folder: str) -> DataFrame:
    return _engineered(spark, folder).select("Ticker", "News_Date", *round_all(*C.ENGINEERED_COLUMNS))


@query(
    "latest_features",
    with_views(
        "history",
        f"""select {_KEY}, {_ENG_SELECT} from engineered
        qualify row_number() over (partition by ticker order by news_date desc) = 1""",
        _FEATURES,
    ),
)
def latest_features(spark: SparkSession, folder: str) -> DataFrame:
    last = FE.latest_rows(_engineered(spark, folder))
    return last.select("Ticker", "News_Date", *round_all(*C.ENGINEERED_COLUMNS))


_SAME_DAY_SQL = dict(
    zip(
        C.SAME_DAY_COLUMNS,
        ["open", "high", "low", "close", "volume", "coalesce((high - low) / nullif(close, 0) * 100.0, 0.0::double)",
         "coalesce((close - open) / nullif(open, 0) * 100.0, 0.0::double)", "score", *_T],
    )
)
_RAW = set(C.SAME_DAY_COLUMNS[:5])
_SAME_DAY_SELECT = ", ".join(f'{v if k in _RAW else r(v)} as "{k}"' for k, v in _SAME_DAY_SQL.items())


@query("same_day_features", with_views("history", f"select {_KEY}, {_SAME_DAY_SELECT} from history"))
def same_day_features(spark: SparkSession, folder: str) -> DataFrame:
    df = FE.same_day(I.history(spark, folder))
    return df.select("Ticker", "News_Date", *[F.col(c) if c in _RAW else rounded(c).alias(c) for c in C.SAME_DAY_COLUMNS])


def _weight(i: int) -> float:
    return (i + 1) ** 0.5


def _checksum_sql(columns: list[str], values: dict[str, str]) -> str:
    return r(" + ".join(f"{_weight(i)!r}::double * ({values[c]})" for i, c in enumerate(columns)), 2)


@query(
    "feature_sets",
    with_views(
        "history",
        " union all ".join(
            f"""select {_KEY}, '{name}' as "Feature_Set", {len(cols)} as "Width",
            {_checksum_sql(cols, _SAME_DAY_SQL if name == 'stock_news_v1' else _ENG_SQL)} as "Position_Sum" from engineered"""
            for name, cols in C.FEATURE_SETS.items()
        ),
        _FEATURES,
    ),
)
def feature_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Every named feature vector of every row, stated by its width and position-weighted sum."""
    prices = ["Open", "High", "Low", "Close", "Volume"]
    df = FE.engineered(I.history(spark, folder), _codes(spark, folder), keep=prices)
    df = df.withColumns({n: c for n, c in FE.same_day_columns().items() if n not in df.columns})
    sets = F.array(
        *[
            F.struct(F.lit(name).alias("Feature_Set"), F.array(*[F.col(c) for c in cols]).alias("v"))
            for name, cols in C.FEATURE_SETS.items()
        ]
    )
    weighted = F.aggregate(
        F.zip_with("v", F.array(*[F.lit(_weight(i)) for i in range(20)]), lambda x, w: F.coalesce(x, F.lit(0.0)) * w),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    return df.select("Ticker", "News_Date", F.inline(sets)).select(
        "Ticker", "News_Date", "Feature_Set", F.size("v").alias("Width"), rounded(weighted, 2).alias("Position_Sum")
    )


@query(
    "feature_sequences",
    with_views(
        "history",
        f"""select e.ticker as "Ticker", e.news_date as "News_Date", s.i as "Step", {r('f.score')} as "Sentiment_Score",
        {r('f.rng')} as "NewsDay_Range_Pct", {r('f.m7')} as "Momentum_RollMean_7"
        from ranked e cross join range(1, 16) s(i)
        join ranked f on f.ticker = e.ticker and f.rn = greatest(1, e.rn - 15 + s.i)""",
        [
            *_FEATURES,
            (
                "ranked",
                "select *, row_number() over (partition by ticker order by news_date) as rn from engineered",
            ),
        ],
    ),
)
def feature_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """Padded 15-day sequences of every ticker and day, one row per step."""
    cols = ["Sentiment_Score", "NewsDay_Range_Pct", "Momentum_RollMean_7"]
    seqs = FE.sequences(_engineered(spark, folder), cols)
    steps = seqs.select("Ticker", "News_Date", F.posexplode("seq").alias("i", "v"))
    return steps.select(
        "Ticker", "News_Date", (F.col("i") + 1).cast("bigint").alias("Step"),
        *[rounded(F.get("v", F.lit(k))).alias(c) for k, c in enumerate(cols)],
    )


# --- scaling --------------------------------------------------------------------------------------

_SCALED = ("open", "close", "volume", "flat")
_FIT_SQL = " union all ".join(
    f"""select '{c}' as feature, avg({c}) as mean, case when stddev_pop({c}) > 0 then stddev_pop({c}) else 1.0::double end as scale
    from s""" for c in _SCALED
)
_SCALE_VIEWS = [("s", "select *, 7.0::double as flat from bars"), ("fit", _FIT_SQL)]


def _scaled_bars(spark: SparkSession, folder: str) -> DataFrame:
    df = I.bars(spark, folder)
    return df.select("Ticker", "Date", *[F.col(c.capitalize()).alias(c) for c in _SCALED[:3]], F.lit(7.0).alias("flat"))


@query(
    "scaler_fit",
    with_views("bars", f"""select feature as "Feature", {r('mean')} as "Mean", {r('scale')} as "Scale" from fit""", _SCALE_VIEWS),
)
def scaler_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Mean and population deviation; a constant column scales by 1."""
    fit = FC.fit_scaler(_scaled_bars(spark, folder), _SCALED)
    return fit.select(F.col("feature").alias("Feature"), rounded("mean").alias("Mean"), rounded("scale").alias("Scale"))


@query(
    "scaler_apply",
    with_views(
        "bars",
        f"""select ticker as "Ticker", bar_date as "Date",
        {r("(close - (select mean from fit where feature = 'close')) / (select scale from fit where feature = 'close')")} as "Scaled",
        {r("(flat - (select mean from fit where feature = 'flat')) / (select scale from fit where feature = 'flat')")} as "Flat_Scaled",
        {r("open / close * (select scale from fit where feature = 'open') + (select mean from fit where feature = 'open')", 4)} as "Inverse"
        from s""",
        _SCALE_VIEWS,
    ),
)
def scaler_apply(spark: SparkSession, folder: str) -> DataFrame:
    """Standardise with fitted values, and map a unit-free value back to prices."""
    df = _scaled_bars(spark, folder)
    fit = FC.scaler_values(FC.fit_scaler(df, _SCALED))
    return df.select(
        "Ticker",
        "Date",
        rounded(FC.standardize(F.col("close"), *fit["close"])).alias("Scaled"),
        rounded(FC.standardize(F.col("flat"), *fit["flat"])).alias("Flat_Scaled"),
        rounded(FC.unstandardize(F.col("open") / F.col("close"), *fit["open"]), 4).alias("Inverse"),
    )
