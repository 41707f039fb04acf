"""Queries over price models and their realised accuracy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.operators import features as FE
from presspulse.operators import forecast as FC
from presspulse.operators import regression as R
from presspulse.plans import inputs as I
from presspulse.plans import jobs as J
from presspulse.plans.registry import query, round_all, rounded
from presspulse.plans.sql import r, with_views
from presspulse.sources.storage import new_path

_KEY = 'ticker as "Ticker", news_date as "News_Date", model_name as "Model_Name", target as "Target"'
_KEYS = ("Ticker", "News_Date", "Model_Name", "Target")


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return I.bars(spark, folder).withColumnRenamed("Date", "News_Date")


@query(
    "predict_long",
    with_views(
        "clamped",
        f"""select {_KEY}, 'formula' as "Backend", model_name = 'swing' as "Unverified", last_close as "Last_Close",
        raw_value as "Raw_Predicted_Value", value as "Predicted_Value" from clamped""",
    ),
)
def predict_long(spark: SparkSession, folder: str) -> DataFrame:
    df = I.formula_predictions(spark, folder)
    return df.select(*_KEYS, "Backend", "Unverified", "Last_Close", "Raw_Predicted_Value", "Predicted_Value")


@query(
    "clamped_predictions",
    with_views(
        "clamped",
        f"""select {_KEY}, raw_value as "Raw_Predicted_Value", value as "Predicted_Value" from clamped where raw_value <> value""",
    ),
)
def clamped_predictions(spark: SparkSession, folder: str) -> DataFrame:
    df = FC.clamped_only(I.formula_predictions(spark, folder))
    return df.select(*_KEYS, "Raw_Predicted_Value", "Predicted_Value")


@query(
    "model_comparison",
    with_views(
        "clamped",
        """select ticker as "Ticker", news_date as "News_Date",
        max(case when model_name = 'naive' and target = 'Open' then value end) as "naive_Open",
        max(case when model_name = 'naive' and target = 'Close' then value end) as "naive_Close",
        max(case when model_name = 'swing' and target = 'Open' then value end) as "swing_Open",
        max(case when model_name = 'swing' and target = 'Close' then value end) as "swing_Close",
        count(*) filter (where raw_value <> value) as "Clamped"
        from clamped group by ticker, news_date""",
    ),
)
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """All models side by side per day, with the number of clamped values."""
    long = I.formula_predictions(spark, folder)
    cells = [
        F.max(F.when((F.col("Model_Name") == s.name) & (F.col("Target") == s.target), F.col("Predicted_Value"))).alias(
            f"{s.name}_{s.target}"
        )
        for s, _ in I.FORMULA_SPECS
    ]
    changed = F.count_if(F.col("Raw_Predicted_Value") != F.col("Predicted_Value")).alias("Clamped")
    return long.groupBy("Ticker", "News_Date").agg(*cells, changed)


@query(
    "melt_actuals",
    with_views(
        "actuals", """select ticker as "Ticker", news_date as "News_Date", target as "Target", actual as "Actual_Value" from actuals"""
    ),
)
def melt_actuals(spark: SparkSession, folder: str) -> DataFrame:
    return FC.melt_actuals(_daily(spark, folder))


@query(
    "monitor_join",
    with_views(
        "clamped actuals",
        f"""select {_KEY}, value as "Predicted_Value", actual as "Actual_Value"
        from clamped join actuals using (ticker, news_date, target)""",
    ),
)
def monitor_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every prediction with its realised value, in place of the value it had; a prediction for a day
    without a stored row has none and is left out."""
    stale = I.formula_predictions(spark, folder).withColumn("Actual_Value", F.lit(-1.0))
    beyond = stale.withColumn("News_Date", F.date_add("News_Date", 36525))
    return FC.with_actuals(stale.unionByName(beyond), FC.melt_actuals(_daily(spark, folder))).select(*_KEYS, "Predicted_Value", "Actual_Value")


# Actuals of Brand#2 are constant, of Brand#3 partly zero, and Brand#4 has one missing value.
_EDGE_SQL = """
  select c.ticker, c.model_name, c.target, c.news_date, c.value as p, c.last_close as prev,
    case when c.ticker = 'Brand#2' then 50.0::double
         when c.ticker = 'Brand#3' and month(c.news_date) = 1 then 0.0::double
         when c.ticker = 'Brand#4' and c.news_date = (select min(bar_date) from bars where ticker = 'Brand#4') then null
         else a.actual end as a
  from clamped c join actuals a using (ticker, news_date, target)"""


def _metrics_sql(source: str) -> str:
    return f"""
  select ticker as "Ticker", model_name as "Model_Name", target as "Target", count(*) as "N_Samples",
    {r('avg(abs(a - p))', 4)} as "MAE", {r('sqrt(avg((a - p) * (a - p)))', 4)} as "RMSE",
    {r('avg(case when a <> 0 then abs((a - p) / a) end) * 100', 4)} as "MAPE",
    {r('''case when count(*) < 2 then null when max(a) = min(a) then
       case when sum((a - p) * (a - p)) = 0 then 1.0::double else 0.0::double end
       else 1 - sum((a - p) * (a - p)) / (var_pop(a) * count(*)) end''')} as "R2",
    {r('avg(case when sign(a - prev) = sign(p - prev) then 1.0::double else 0.0::double end)')} as "Direction_Accuracy"
  from ({source}) group by ticker, model_name, target having count(a) = count(*)"""


def _round_metrics(df: DataFrame) -> DataFrame:
    return df.select(
        "Ticker", "Model_Name", "Target", "N_Samples",
        *round_all("MAE", "RMSE", "MAPE", digits=4), *round_all("R2", "Direction_Accuracy"),
    )


def _edge_pairs(spark: SparkSession, folder: str) -> DataFrame:
    joined = FC.with_actuals(I.formula_predictions(spark, folder), FC.melt_actuals(_daily(spark, folder)))
    first = _daily(spark, folder).where("Ticker = 'Brand#4'").select(F.min("News_Date")).scalar()
    actual = (
        F.when(F.col("Ticker") == "Brand#2", 50.0)
        .when((F.col("Ticker") == "Brand#3") & (F.month("News_Date") == 1), 0.0)
        .when((F.col("Ticker") == "Brand#4") & (F.col("News_Date") == first), F.lit(None))
        .otherwise(F.col("Actual_Value"))
    )
    return joined.withColumn("Actual_Value", actual)


def _edge_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return FC.accuracy(_edge_pairs(spark, folder))


@query("performance_metrics", with_views("clamped actuals", _metrics_sql(_EDGE_SQL)))
def performance_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy per ticker, model and target, with constant, zero and missing actuals among them."""
    return _round_metrics(_edge_metrics(spark, folder))


@query("accuracy_from_days", with_views("clamped actuals", _metrics_sql(_EDGE_SQL)))
def accuracy_from_days(spark: SparkSession, folder: str) -> DataFrame:
    """The same metrics merged from stored parts, one a day."""
    path = new_path(spark, "accuracy-parts")
    FC.accuracy_parts(_edge_pairs(spark, folder)).write.parquet(path)
    return _round_metrics(FC.merged_accuracy(spark.read.parquet(path)))


_NEXT_SQL = """
  select c.ticker, c.model_name, c.target, c.value as p, c.last_close as prev,
    case c.target when 'Open' then n.o else n.c end as a
  from clamped c join (select ticker, bar_date, lead(open) over (partition by ticker order by bar_date) as o,
      lead(close) over (partition by ticker order by bar_date) as c from bars) n
    on n.ticker = c.ticker and n.bar_date = c.news_date where n.o is not null"""


@query("monitor_next_session", with_views("clamped", _metrics_sql(_NEXT_SQL)))
def monitor_next_session(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy against the session after the prediction."""
    return _round_metrics(J.monitor(I.formula_predictions(spark, folder), _daily(spark, folder), horizon=1))


@query(
    "perf_alerts",
    with_views(
        "clamped actuals",
        f"""select "Ticker", "Model_Name", "Target", concat_ws('; ', case when "MAPE" > 5 then 'MAPE above threshold' end,
          case when "Direction_Accuracy" < 0.5 then 'Direction accuracy below threshold' end) as "Reasons"
        from ({_metrics_sql(_EDGE_SQL)}) where "MAPE" > 5 or "Direction_Accuracy" < 0.5""",
    ),
)
def perf_alerts(spark: SparkSession, folder: str) -> DataFrame:
    found = FC.alerts(_edge_metrics(spark, folder))
    return found.select("Ticker", "Model_Name", "Target", F.array_join("reasons", "; ").alias("Reasons"))


# --- trained models -----------------------------------------------------------------------------

_TRAINED = ("Open", "High", "Low", "Close", "Volume", "Sentiment_Score", *C.TOPIC_COLUMNS)


@query("train_price_models")
def train_price_models(spark: SparkSession, folder: str) -> DataFrame:
    """Fit on the whole history and report the in-sample error per target and the explained variance."""
    daily = I.history(spark, folder)
    fit, model = R.train(daily, _TRAINED)
    scored = R.predict(R.next_day_targets(daily), fit, model)
    explained = float(model.stages[1].explainedVariance.toArray().sum())
    errors = [
        F.struct(
            F.lit(t).alias("Target"),
            F.count(f"Next_{t}").alias("Rows"),
            F.sqrt(F.avg(F.pow(F.col(f"Next_{t}") - F.col(f"Predicted_{t}"), 2))).alias("RMSE"),
            F.stddev_pop(f"Next_{t}").alias("Target_Std"),
            F.lit(explained).alias("Explained_Variance"),
        )
        for t in R.TARGETS
    ]
    return scored.agg(F.array(*errors).alias("e")).select(F.inline("e"))


@query("ml_predictions")
def ml_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Trained and formula models over the whole history, in one long table."""
    daily = I.history(spark, folder)
    fit, model = R.train(daily, _TRAINED)
    df = R.predict(daily, fit, model)
    trained = [
        (C.ModelSpec("pca_regression", t, "spark_ml", "stock_news_v1"), F.col(f"Predicted_{t}")) for t in R.TARGETS
    ]
    models = trained + [(s, fn(df)) for s, fn in I.FORMULA_SPECS]
    out = FC.predict_long(df, models, ["Ticker", "News_Date"])
    return out.select(
        *_KEYS, "Backend", rounded("Raw_Predicted_Value", 4).alias("Raw_Predicted_Value"),
        rounded("Predicted_Value", 4).alias("Predicted_Value"),
    )


_OLS = "regr_intercept({y}, close) over () + regr_slope({y}, close) over () * close"


_LINE_SQL = with_views(
    "bars",
    f"""select ticker as "Ticker", bar_date as "News_Date", {r(_OLS.format(y='no'), 3)} as "Predicted_Open",
    {r(_OLS.format(y='nc'), 3)} as "Predicted_Close" from (
      select ticker, bar_date, close, lead(open) over w as no, lead(close) over w as nc from bars
      window w as (partition by ticker order by bar_date))""",
)


@query("single_factor_model", _LINE_SQL)
def single_factor_model(spark: SparkSession, folder: str) -> DataFrame:
    """The trained chain with the close as its only input, which is an ordinary regression line."""
    daily = _daily(spark, folder)
    fit, model = R.train(daily, ["Close"], components=1)
    out = R.predict(daily, fit, model)
    return out.select("Ticker", "News_Date", *[rounded(f"Predicted_{t}", 3).alias(f"Predicted_{t}") for t in R.TARGETS])


@query("stored_model_predictions", _LINE_SQL)
def stored_model_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """The same line, stored twice as a model, loaded in its newest version and applied as a column."""
    daily, path = _daily(spark, folder), new_path(spark, "models")
    for component_of in ("Open", "Close"):
        fit, model = R.train(daily, [component_of], components=1)
        R.store_models(spark, path, "line", fit, model, 0)
    prices = {f"Predicted_{m.target}": rounded(fn(daily), 3) for m, fn in R.stored_models(spark, path, ["line"])}
    return daily.select("Ticker", "News_Date", *[c.alias(n) for n, c in prices.items()])


# --- the configured models ------------------------------------------------------------------------


def stretched(x: np.ndarray) -> np.ndarray:
    """Stand-in for the two-output model: its scaled open and close, moved away from the mean."""
    return x[:, [0, 3]] * 1.1


def mean_mood(x: np.ndarray) -> np.ndarray:
    """Stand-in for the sequence models: mean sentiment over the steps."""
    return x[:, :, 0].mean(axis=1)


_STRETCH = "1.1::double * ({c} - (select avg({c}) from history)) + (select avg({c}) from history)"
_MOOD = "mood * (select stddev_pop({c}) from history) + (select avg({c}) from history)"
_CONFIGURED = [
    ("ranked", "select *, row_number() over (partition by ticker order by news_date) as rn from history"),
    (
        "moods",
        """select e.ticker, e.news_date, avg(f.score) as mood from ranked e cross join range(1, 16) s(i)
        join ranked f on f.ticker = e.ticker and f.rn = greatest(1, e.rn - 15 + s.i) group by e.ticker, e.news_date""",
    ),
    (
        "raw",
        " union all ".join(
            f"""select h.ticker, h.news_date, '{name}' as model_name, '{target}' as target, h.close as last_close,
            {sql.format(c=target.lower())} as raw from history h join moods using (ticker, news_date)"""
            for name, sql in (("stock_news_rf", _STRETCH), ("lstm_keras", _MOOD))
            for target in ("Open", "Close")
        ),
    ),
]


@query(
    "configured_models",
    with_views(
        "history",
        f"""select {_KEY}, case model_name when 'lstm_keras' then 'keras' else 'sklearn' end as "Backend", true as "Unverified",
        {r('raw', 3)} as "Raw_Predicted_Value",
        {r('greatest(last_close * 0.8::double, least(last_close * 1.2::double, raw)) / last_close')} as "Share_Of_Close" from raw""",
        _CONFIGURED,
    ),
)
def configured_models(spark: SparkSession, folder: str) -> DataFrame:
    """The configured model list over the whole history: same-day and sequence inputs, input and
    target scaling, two outputs of one model, and all results in one long table. The trained
    artifacts are not public, so stand-in functions take their places."""
    daily = I.history(spark, folder)
    stats = FC.scaler_values(FC.fit_scaler(FE.same_day(daily), C.SAME_DAY_COLUMNS))
    # the target scaling is that of the same day's open and close
    targets = [stats["News_Day_Open"], stats["News_Day_Close"]]
    codes = FE.ticker_codes(I.companies(spark, folder))
    df = FE.engineered(daily, codes, keep=["Open", "High", "Low", "Close", "Volume"])
    df = df.withColumns({n: c for n, c in FE.same_day_columns().items() if n not in df.columns})
    models = []
    for s in C.MODEL_SPECS:
        columns = C.FEATURE_SETS[s.feature_set]
        if s.sequence_length:
            name = f"seq_{s.target}"
            df = FE.add_sequence(df, columns, name, s.sequence_length)
            scale = [targets[0 if s.target == "Open" else 1]]
            models.append((s, FC.batch_price_model(mean_mood, scale, steps=s.sequence_length)(F.col(name))))
        else:
            vector = F.array(*[FC.standardize(F.col(c), *stats[c]) for c in columns])
            models.append((s, FC.batch_price_model(stretched, targets, s.output_index)(vector)))
    out = FC.predict_long(df, models, ["Ticker", "News_Date"])
    return out.select(
        *_KEYS, "Backend", "Unverified", rounded("Raw_Predicted_Value", 3).alias("Raw_Predicted_Value"),
        rounded(F.col("Predicted_Value") / F.col("Last_Close")).alias("Share_Of_Close"),
    )


# --- models that fail -------------------------------------------------------------------------------


def _picky(x: np.ndarray) -> np.ndarray:
    """Refuses a whole batch for one row with a volume that 97 divides."""
    if (x[:, 1] % 97 == 0).any():
        raise ValueError("volume")
    return x[:, 0] * 2.0


@query(
    "model_failures",
    with_views(
        "bars",
        f"""select ticker as "Ticker", bar_date as "News_Date", volume::bigint % 97 = 0 as "Failed",
        case when volume::bigint % 97 <> 0 then close * 2.0::double end as "Predicted_Close" from bars""",
    ),
)
def model_failures(spark: SparkSession, folder: str) -> DataFrame:
    """An external model that raises on some rows: exactly those have no prediction and are counted as
    failed, however the rows were put into batches."""
    predicted = FC.batch_price_model(_picky)(F.array("Close", "Volume"))
    scored = I.bars(spark, folder).select("Ticker", F.col("Date").alias("News_Date"), predicted.alias("p"))
    value = F.when(F.col("p").isNotNull() & ~F.isnan("p"), F.col("p"))
    return scored.select("Ticker", "News_Date", value.isNull().alias("Failed"), value.alias("Predicted_Close"))
