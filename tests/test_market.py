from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.operators import features as FE
from presspulse.operators import forecast as FC
from presspulse.operators import market as MK
from presspulse.operators import regression as R


def price_frame(n=200, seed=0, sigma=0.02, ticker="T"):
    rng = np.random.default_rng(seed)
    close = 100 * np.exp(np.cumsum(rng.normal(0, sigma, n)))
    dates = pd.date_range("2025-01-01", periods=n, freq="D").date
    return pd.DataFrame(
        {"Ticker": ticker, "Date": dates, "Open": close * 0.99, "High": close * 1.02, "Low": close * 0.97, "Close": close,
         "Volume": 1e6 + 1000.0 * np.arange(n)}
    )


def load(spark, *frames):
    return MK.normalize_bars(spark.createDataFrame(pd.concat(frames)))


def values(df, column):
    return [r[0] for r in df.orderBy("Date").select(column).collect()]


def test_rolling_volatility_equals_pandas(spark):
    pdf = price_frame()
    pdf.loc[50, "Close"] = np.nan
    got = values(MK.add_rolling_volatility(load(spark, pdf)), "Volatility")
    lr = np.log(pdf["Close"] / pdf["Close"].shift(1))
    want = lr.rolling(90, min_periods=30).std()
    assert [x is None for x in got] == want.isna().tolist()
    assert np.allclose([x for x in got if x is not None], want.dropna())


def test_flat_prices_have_no_volatility_and_noise_raises_it(spark):
    flat = price_frame(50).assign(Close=100.0)
    assert values(MK.add_rolling_volatility(load(spark, flat), 10), "Volatility")[-1] == 0.0
    both = load(spark, price_frame(sigma=0.005, ticker="calm"), price_frame(sigma=0.05, ticker="wild"))
    last = dict(MK.latest_value(MK.add_rolling_volatility(both), "Volatility").collect())
    assert last["wild"] > last["calm"] > 0


def test_atr_equals_pandas(spark):
    pdf = price_frame(40)
    prev = pdf["Close"].shift(1)
    tr = pd.concat([pdf.High - pdf.Low, (pdf.High - prev).abs(), (pdf.Low - prev).abs()], axis=1).max(axis=1)
    want = tr.rolling(14, min_periods=4).mean() / pdf.Close
    got = values(MK.add_atr(load(spark, pdf)), "ATR_Over_Close")
    assert [x is None for x in got] == want.isna().tolist()
    assert np.allclose([x for x in got if x is not None], want.dropna()) and min(x for x in got if x is not None) >= 0


def test_bars_are_normalized(spark):
    df = spark.createDataFrame([("T", dt.date(2025, 1, 1), 1.0, float("nan"), 2.0)], "Ticker string, Date date, Close double, Open double, `Adj Close` double")
    assert MK.normalize_bars(df).first().asDict() == {
        "Ticker": "T", "Date": dt.date(2025, 1, 1), "Open": None, "High": None, "Low": None, "Close": 1.0, "Adj_Close": 2.0, "Volume": None,
    }
    assert MK.normalize_bars(df.drop("Adj Close")).first()["Adj_Close"] == 1.0


def test_lookback_and_latest_bar(spark):
    df = load(spark, price_frame(30), price_frame(10, ticker="S"))
    assert MK.lookback(df, F.lit(dt.date(2025, 1, 30)), 5).count() == 5
    assert {r["Ticker"]: r["Date"] for r in MK.latest_bar(df).collect()} == {"T": dt.date(2025, 1, 30), "S": dt.date(2025, 1, 10)}
    assert MK.latest_bar(df.limit(0)).count() == 0


def test_as_of_carries_the_last_known_value(spark):
    left = spark.createDataFrame([("A", dt.date(2025, 1, d), d) for d in (1, 3, 5)] + [("B", dt.date(2025, 1, 3), 9)], "k string, d date, x int")
    right = spark.createDataFrame([("A", dt.date(2025, 1, 3), 30.0), ("A", dt.date(2025, 1, 4), None), ("C", dt.date(2025, 1, 1), 1.0)], "k string, t date, v double")
    got = MK.as_of_last(left, right, ["k"], "d", "t", ["v"])
    assert sorted((r["k"], r["x"], r["v"]) for r in got.collect()) == [("A", 1, None), ("A", 3, 30.0), ("A", 5, 30.0), ("B", 9, None)]


def test_reference_volatility_is_the_median_with_a_default(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.3), (1, None), (1, 0.2), (2, None), (3, 0.0)], "day int, Volatility double")
    assert dict(MK.reference_volatility(df, "day").collect()) == {1: 0.2, 2: 0.02, 3: 0.02}
    spread = MK.add_reference_volatility(df, "day")
    assert {(r["day"], r["Reference_Volatility"]) for r in spread.collect()} == {(1, 0.2), (2, 0.02), (3, 0.02)}


def daily_frame(n, ticker="T"):
    i = np.arange(n)
    close = 100 + 1.5 * i
    frame = pd.DataFrame(
        {"Ticker": ticker, "News_Date": pd.date_range("2026-01-01", periods=n, freq="D").date, "Open": 100.0 + i, "High": close + 2,
         "Low": close - 2, "Close": close, "Volume": 1e6 + 1000.0 * i, "Sentiment_Score": 0.1 * (i % 3)}
    )
    return frame.assign(**{c: 1 / 6 for c in C.TOPIC_COLUMNS})


def pandas_features(h, code):
    out = pd.DataFrame({"Sentiment_Score": h.Sentiment_Score, **{c: h[c] for c in C.TOPIC_COLUMNS}})
    out["NewsDay_Intraday_Pct"] = (h.Close - h.Open) / h.Open * 100
    out["NewsDay_Range_Pct"] = (h.High - h.Low) / h.Close * 100
    out["Log_Volume"] = np.log1p(h.Volume)
    dates = pd.to_datetime(h.News_Date)
    for name, v, p in (("Month", dates.dt.month, 12), ("DOW", dates.dt.dayofweek, 7)):
        out[f"{name}_sin"], out[f"{name}_cos"] = np.sin(2 * np.pi * v / p), np.cos(2 * np.pi * v / p)
    ret = h.Close.pct_change().fillna(0) * 100
    for k in (3, 7):
        out[f"Sentiment_RollMean_{k}"] = h.Sentiment_Score.rolling(k, min_periods=1).mean()
        out[f"Momentum_RollMean_{k}"] = ret.rolling(k, min_periods=1).mean()
    out["Volatility_Roll7"] = np.log(h.Close / h.Close.shift(1)).rolling(7, min_periods=2).std()
    out["Ticker_Code"] = code
    return out.fillna(0.0)[C.ENGINEERED_COLUMNS]


def test_engineered_features_equal_pandas(spark):
    frames = {"T": daily_frame(30), "U": daily_frame(3, "U")}
    codes = FE.ticker_codes(spark.createDataFrame([("Z",), ("T",), ("A",)], "ticker string"))
    got = FE.engineered(spark.createDataFrame(pd.concat(frames.values())), codes)
    assert got.columns[2:] == C.ENGINEERED_COLUMNS
    for ticker, code in (("T", 1), ("U", -1)):
        have = got.where(F.col("Ticker") == ticker).orderBy("News_Date").toPandas()[C.ENGINEERED_COLUMNS]
        assert np.allclose(have, pandas_features(frames[ticker], code), atol=1e-9)
    last = FE.latest_rows(got).where("Ticker = 'T'").first()
    assert last["News_Date"] == dt.date(2026, 1, 30) and last["Sentiment_Score"] == pytest.approx(0.2)


def test_ticker_codes_are_alphabetical(spark):
    codes = FE.ticker_codes(spark.createDataFrame([("ZZZ.NS",), ("AAA.NS",), ("MMM.NS",), ("AAA.NS",)], "ticker string"))
    assert dict(codes.collect()) == {"AAA.NS": 0, "MMM.NS": 1, "ZZZ.NS": 2}


@pytest.mark.parametrize("n", [1, 5, 15, 20])
def test_sequences_are_padded_with_the_first_row(spark, n):
    df = spark.createDataFrame(daily_frame(n))
    seqs = FE.sequences(df, ["Close", "Open"]).orderBy("News_Date").collect()
    closes = [100 + 1.5 * i for i in range(n)]
    for i, row in enumerate(seqs):
        want = ([closes[0]] * 15 + closes[: i + 1])[-15:] if i < 14 else closes[i - 14 : i + 1]
        assert [step[0] for step in row["seq"]] == want and len(row["seq"]) == 15


def test_same_day_features_survive_missing_values(spark):
    df = spark.createDataFrame([("T", dt.date(2026, 1, 1), None, 5.0, 4.0, 0.0, None, None, *[None] * 6)],
        "Ticker string, News_Date date, Open double, High double, Low double, Close double, Volume double, Sentiment_Score double, "
        + ", ".join(f"{c} double" for c in C.TOPIC_COLUMNS))
    row = FE.same_day(df).first()
    assert row["Day_High_Low_Spread_Pct"] == row["Day_Close_Open_Spread_Pct"] == row["News_Day_Open"] == 0.0
    assert len(FE.feature_vector(FE.same_day(df), "stock_news_v1").first()["features"]) == 14


# --- forecasts ------------------------------------------------------------------------------


def spec(name, target="Close"):
    return C.ModelSpec(name, target, "formula", "stock_news_v1", unverified=name == "wild")


def test_a_failing_model_yields_no_row_and_the_rest_goes_on(spark):
    df = spark.createDataFrame([("T", 100.0, 1.0), ("U", None, 2.0)], "Ticker string, Close double, x double")
    models = [
        (spec("good"), F.col("x") * 90), (spec("wild", "Open"), F.col("Close") * 3), (spec("broken"), F.lit(None)),
        (spec("nan"), F.lit(float("nan"))),
    ]
    rows = {(r["Ticker"], r["Model_Name"]): r for r in FC.predict_long(df, models, ["Ticker"]).collect()}
    assert set(rows) == {("T", "good"), ("T", "wild"), ("U", "good")}
    assert (rows["T", "wild"]["Predicted_Value"], rows["T", "wild"]["Raw_Predicted_Value"], rows["T", "wild"]["Unverified"]) == (120.0, 300.0, True)
    assert rows["U", "good"]["Predicted_Value"] == 180.0  # no close, no band
    assert FC.clamped_only(FC.predict_long(df, models, ["Ticker"])).count() == 1


def test_external_models_scale_pick_and_fail_alone(spark):
    df = spark.createDataFrame([("T", 100.0, [1.0, 2.0]), ("U", 100.0, [3.0, 4.0])], "Ticker string, Close double, v array<double>")

    def broken(x):
        raise RuntimeError("no artifact")

    two = FC.batch_price_model(lambda x: x, [(100.0, 1.0), (90.0, 10.0)], 1)
    models = [(spec("two"), two(F.col("v"))), (spec("broken"), FC.batch_price_model(broken)(F.col("v")))]
    got = FC.predict_long(df, models, ["Ticker"]).collect()
    assert {(r["Ticker"], r["Model_Name"], r["Raw_Predicted_Value"], r["Predicted_Value"]) for r in got} == {
        ("T", "two", 110.0, 110.0), ("U", "two", 130.0, 120.0),
    }


@pytest.mark.parametrize("rows_at_once", ["13", "10000"])
def test_only_the_failing_rows_are_lost(spark, rows_at_once):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def picky(x):
        if (x[:, 0] == 17).any():
            raise ValueError("seventeen")
        return x[:, 0]

    try:
        spark.conf.set(key, rows_at_once)
        df = spark.range(200).select(F.col("id").cast("double").alias("v"))
        p = df.select(FC.batch_price_model(picky)(F.array("v")).alias("p")).where("p is not null and not isnan(p)")
        assert sorted(r["p"] for r in p.collect()) == [float(i) for i in range(200) if i != 17]
    finally:
        spark.conf.set(key, before)


def metrics(spark, rows):
    df = spark.createDataFrame([("T", "m", "Close", *r) for r in rows], "Ticker string, Model_Name string, Target string, Actual_Value double, Predicted_Value double, Last_Close double")
    return FC.accuracy(df)


def test_accuracy_metrics(spark):
    rows = [(10.0, 11.0, 9.0), (0.0, 1.0, 1.0), (20.0, 18.0, 19.0)]
    got = metrics(spark, rows).first()
    a, p, prev = map(np.array, zip(*rows))
    assert got["N_Samples"] == 3
    assert got["MAE"] == pytest.approx(np.abs(a - p).mean()) and got["RMSE"] == pytest.approx(np.sqrt(((a - p) ** 2).mean()))
    assert got["MAPE"] == pytest.approx((0.1 + 0.1) / 2 * 100)
    assert got["R2"] == pytest.approx(1 - ((a - p) ** 2).sum() / ((a - a.mean()) ** 2).sum())
    assert got["Direction_Accuracy"] == pytest.approx((np.sign(a - prev) == np.sign(p - prev)).mean())


@pytest.mark.parametrize(
    "rows, r2, mape", [([(5.0, 5.0, 5.0)], None, 0.0), ([(5.0, 5.0, 4.0)] * 2, 1.0, 0.0), ([(5.0, 4.0, 4.0)] * 2, 0.0, 20.0), ([(0.0, 1.0, 1.0)] * 2, 0.0, None)]
)
def test_accuracy_edges(spark, rows, r2, mape):
    got = metrics(spark, rows).first()
    assert (got["R2"], got["MAPE"]) == (r2, mape)


def test_a_group_with_missing_input_has_no_row(spark):
    assert metrics(spark, [(5.0, 5.0, 5.0), (None, 5.0, 5.0)]).count() == 0
    assert metrics(spark, [(5.0, float("nan"), 5.0)]).count() == 0


def test_alerts_ignore_missing_metrics(spark):
    df = spark.createDataFrame([("a", 5.0, 0.5), ("b", 5.1, 0.9), ("c", None, 0.4), ("d", None, None), ("e", 9.0, 0.1)], "k string, MAPE double, Direction_Accuracy double")
    assert {r["k"]: len(r["reasons"]) for r in FC.alerts(df).collect()} == {"b": 1, "c": 1, "e": 2}


def test_actuals_join_replaces_a_stale_value(spark):
    daily = spark.createDataFrame([("T", dt.date(2025, 1, d), 10.0 + d, 20.0 + d) for d in (1, 2)], "Ticker string, News_Date date, Open double, Close double")
    preds = spark.createDataFrame([("T", dt.date(2025, 1, d), "m", "Open", 1.0, -1.0) for d in (1, 2, 3)], "Ticker string, News_Date date, Model_Name string, Target string, Predicted_Value double, Actual_Value double")
    assert sorted(r["Actual_Value"] for r in FC.with_actuals(preds, FC.melt_actuals(daily)).collect()) == [11.0, 12.0]
    assert [r["Actual_Value"] for r in FC.with_actuals(preds, FC.melt_actuals(FC.next_session(daily))).collect()] == [12.0]


def test_scaler_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (4.0, 7.0)], "x double, c double")
    fit = FC.scaler_values(FC.fit_scaler(df, ["x", "c"]))
    assert fit["x"] == (pytest.approx(7 / 3), pytest.approx(np.std([1, 2, 4]))) and fit["c"] == (7.0, 1.0)
    z = df.select(FC.standardize(F.col("x"), *fit["x"]).alias("z"))
    back = [r[0] for r in z.select(FC.unstandardize(F.col("z"), *fit["x"])).collect()]
    assert back == pytest.approx([1.0, 2.0, 4.0])


def test_trained_regression_equals_numpy(spark):
    rng = np.random.default_rng(1)
    n = 120
    pdf = pd.DataFrame({"Ticker": "T", "News_Date": pd.date_range("2025-01-01", periods=n, freq="D").date})
    for c in ("Open", "Close", "a", "b"):
        pdf[c] = rng.normal(100, 5, n)
    columns = ["Open", "Close", "a", "b"]
    daily = spark.createDataFrame(pdf)
    fit, model = R.train(daily, columns, components=2)
    got = R.predict(daily, fit, model).orderBy("News_Date").toPandas()
    x = pdf[columns].to_numpy()[:-1]
    z = (x - x.mean(0)) / x.std(0)
    _, _, vt = np.linalg.svd(z, full_matrices=False)
    design = np.c_[np.ones(n - 1), z @ vt[:2].T]
    for t in R.TARGETS:
        beta = np.linalg.lstsq(design, pdf[t].to_numpy()[1:], rcond=None)[0]
        assert np.allclose(got[f"Predicted_{t}"][:-1], design @ beta, atol=1e-6)
