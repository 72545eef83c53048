import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.registered import QUERIES
from meterstar.operators import forecast, series

START = dt.date(2025, 1, 1)
IDS = ["Metric"]


def as_series(spark, values, name="m", start=START):
    rows = [(name, start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "Metric string, ds date, y double")


def test_calendar_is_completed_with_zeros(spark):
    rows = [(dt.date(2025, 1, 3), 1.0, 10, 1), (dt.date(2025, 1, 6), 3.0, 30, 2), (None, 9.0, 1, 3)]
    usage = spark.createDataFrame(rows, "Date date, CostUSD double, TotalTokens bigint, UsageID bigint")
    got = series.daily_usage(usage).orderBy("Date").collect()
    assert [r["CostUSD"] for r in got] == [1.0, 0.0, 0.0, 3.0]
    assert [r["RequestCount"] for r in got] == [1, 0, 0, 1]
    assert [r["IsWeekend"] for r in got] == [0, 1, 1, 0]


def test_baselines(spark):
    train = as_series(spark, range(20))
    naive = series.naive(train, IDS, 10).orderBy("ds").collect()
    assert [r["yhat"] for r in naive] == [19.0] * 10
    assert naive[0]["ds"] == dt.date(2025, 1, 21) and naive[0]["yhat_lower"] is None
    cycle = [r["yhat"] for r in series.seasonal_naive(train, IDS, 10).orderBy("ds").collect()]
    assert cycle == [13, 14, 15, 16, 17, 18, 19, 13, 14, 15]
    assert series.seasonal_naive(as_series(spark, range(13)), IDS, 10).count() == 0


def test_split_needs_more_than_two_horizons(spark):
    marked = series.split_holdout(as_series(spark, range(61)), IDS)
    assert marked.where("IsTest").count() == 30 and marked.where("IsTest").agg(F.min("y")).first()[0] == 31
    with pytest.raises(series.ShortSeriesError):
        series.split_holdout(as_series(spark, range(60)), IDS)
    both = as_series(spark, range(61)).union(as_series(spark, range(60), "short"))
    with pytest.raises(series.ShortSeriesError):
        series.split_holdout(both, IDS)
    long, short = series.part_short(both, IDS)
    assert long.count() == 61 and [tuple(r) for r in short.collect()] == [("short", 60, "fewer than 61 days")]


def test_metrics(spark):
    rows = [("a", 1.0, 1.0), ("a", 2.0, 3.0), ("a", 4.0, 3.0), ("z", 0.0, 0.0), ("z", 0.0, 2.0)]
    df = spark.createDataFrame(rows, "Metric string, y double, yhat double")
    got = {r["Metric"]: r for r in series.forecast_metrics(df, IDS).collect()}
    assert got["a"]["MAE"] == pytest.approx(2 / 3) and got["a"]["RMSE"] == pytest.approx(np.sqrt(2 / 3))
    assert got["a"]["MAPE"] == pytest.approx(25.0) and got["a"]["sMAPE"] == pytest.approx(100 * (0.4 + 2 / 7) / 3)
    assert got["z"]["MAPE"] is None and got["z"]["sMAPE"] == pytest.approx(100.0)


def test_forecast_dates_are_checked(spark):
    history = as_series(spark, range(40))
    good = series.naive(history, IDS)
    assert series.require_forecast_dates(good, history, IDS) is good
    short = good.where(F.col("ds") < dt.date(2025, 3, 1))
    overlapping = good.withColumn("ds", F.date_sub("ds", 1))
    repeated = good.withColumn("ds", F.lit(dt.date(2025, 3, 1)))
    for bad in (short, overlapping, repeated, good.where("false")):
        with pytest.raises(series.ForecastDatesError):
            series.require_forecast_dates(bad, history, IDS)


def test_decomposition_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    y = 50 + 0.3 * np.arange(40) + np.tile([5, 1, 0, -2, -3, 4, -5], 6)[:40] + rng.normal(0, 1, 40)
    trend = np.full(40, np.nan)
    for i in range(3, 37):
        trend[i] = y[i - 3 : i + 4].mean()
    head, tail = np.polyfit(np.arange(3, 10), trend[3:10], 1), np.polyfit(np.arange(30, 37), trend[30:37], 1)
    trend[:3], trend[37:] = np.polyval(head, np.arange(3)), np.polyval(tail, np.arange(37, 40))
    effect = np.array([(y - trend)[i::7].mean() for i in range(7)])
    seasonal = np.resize(effect - effect.mean(), 40)
    got = series.decompose_weekly(as_series(spark, y), IDS).orderBy("ds").toPandas()
    np.testing.assert_allclose(got["Trend"], trend, atol=1e-9)
    np.testing.assert_allclose(got["Seasonal"], seasonal, atol=1e-9)
    np.testing.assert_allclose(got["Residual"], y - trend - seasonal, atol=1e-9)
    with pytest.raises(series.ShortSeriesError):
        series.decompose_weekly(as_series(spark, y[:14]), IDS)
    with pytest.raises(series.ShortSeriesError):
        forecast.arima(as_series(spark, y[:8]), IDS)


def test_unit_root_statistic(spark):
    rng = np.random.default_rng(5)
    walk, noise = np.cumsum(rng.normal(0, 1, 300)), rng.normal(0, 1, 300)
    df = as_series(spark, walk, "walk").union(as_series(spark, noise, "noise"))
    got = {r["Metric"]: r["DickeyFullerT"] for r in series.unit_root_statistic(df, IDS).collect()}
    for name, y in (("walk", walk), ("noise", noise)):
        x = np.column_stack([np.ones(299), y[:-1]])
        beta, res, *_ = np.linalg.lstsq(x, np.diff(y), rcond=None)
        error = np.sqrt(res[0] / 297 * np.linalg.inv(x.T @ x)[1, 1])
        assert got[name] == pytest.approx(beta[1] / error)
    assert got["noise"] < -10 < -4 < got["walk"]


def brute_unit_root(y):
    """Lag by AIC on the common sample, then the statistic on the longest one."""
    d, n = np.diff(y), len(y)
    most = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)

    def design(lags, start):
        rows = range(start, len(d))
        x = np.array([[1.0, y[t], *[d[t - i] for i in range(1, lags + 1)]] for t in rows])
        beta, *_ = np.linalg.lstsq(x, d[start:], rcond=None)
        return x, beta, ((d[start:] - x @ beta) ** 2).sum()

    def aic(lags):
        x, _, sse = design(lags, most)
        return len(x) * np.log(sse / len(x)) + 2 * x.shape[1]

    best = min(range(most + 1), key=aic)
    x, beta, sse = design(best, best)
    return best, beta[1] / np.sqrt(sse / (len(x) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])


def test_unit_root_test_matches_brute_force(spark):
    rng = np.random.default_rng(19)
    e = rng.normal(0, 1, 260)
    walk = 50 + np.cumsum(e)
    mixed = [0.0, 0.0]
    for s in e:
        mixed.append(0.5 * mixed[-1] - 0.3 * mixed[-2] + s)
    frames = {"walk": walk, "mixed": np.array(mixed), "short": walk[:40]}
    df = as_series(spark, frames["walk"], "walk")
    for name in ("mixed", "short"):
        df = df.union(as_series(spark, frames[name], name))
    got = {r["Metric"]: r for r in forecast.unit_root_test(df, IDS).collect()}
    for name, y in frames.items():
        lags, t = brute_unit_root(y)
        assert got[name]["Lags"] == lags and got[name]["Statistic"] == pytest.approx(t, rel=1e-5)
    assert got["mixed"]["Stationary"] and not got["walk"]["Stationary"]
    constant = forecast.unit_root_test(as_series(spark, [3.0] * 40), IDS).first()
    assert constant["Statistic"] is None and constant["Stationary"] is None


def test_unit_root_p_values_meet_the_published_critical_values():
    for t, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert forecast.unit_root_p_value(t) == pytest.approx(p, abs=0.002)
    assert forecast.unit_root_p_value(-30) == 0.0 and forecast.unit_root_p_value(5) == 1.0


def test_grouped_least_squares(spark):
    rng = np.random.default_rng(7)
    rows, want = [], {}
    for name in ("a", "b"):
        x, t = rng.normal(0, 1, 50), rng.normal(5, 2, 50)
        y = 2 + 3 * x - t + rng.normal(0, 0.1, 50)
        want[name] = np.linalg.lstsq(np.column_stack([np.ones(50), x, t]), y, rcond=None)
        rows += [(name, *map(float, r)) for r in zip(x, t, y)]
    df = spark.createDataFrame(rows, "g string, x double, t double, y double")
    for r in forecast.grouped_ols(df, ["g"], [F.lit(1.0), F.col("x"), F.col("t")], F.col("y")).collect():
        np.testing.assert_allclose(r["beta"], want[r["g"]][0], rtol=1e-6)
        assert r["sse"] == pytest.approx(want[r["g"]][1][0], rel=1e-6) and r["n"] == 50


def test_seasonal_regression_recovers_trend_weekday_and_holiday(spark):
    days = [START + dt.timedelta(days=i) for i in range(430)]
    effect = [0, 1, 2, 3, 4, -5, -9]
    holidays = {dt.date(2025, 12, 25), dt.date(2025, 7, 4), dt.date(2026, 1, 1), dt.date(2025, 11, 27),
                dt.date(2025, 1, 1), dt.date(2025, 1, 20), dt.date(2025, 2, 17), dt.date(2025, 5, 26),
                dt.date(2025, 6, 19), dt.date(2025, 9, 1), dt.date(2025, 10, 13), dt.date(2025, 11, 11),
                dt.date(2026, 1, 19), dt.date(2026, 2, 16)}
    level = lambda i, d: 100 + 0.5 * i + effect[d.weekday()] + (20 if d in holidays else 0)
    y = [level(i, d) for i, d in enumerate(days)]
    got = forecast.seasonal_regression(as_series(spark, y), IDS).orderBy("ds").collect()
    for i, r in enumerate(got):
        day = days[-1] + dt.timedelta(days=i + 1)
        assert r["ds"] == day and r["yhat"] == pytest.approx(level(430 + i, day), abs=1e-3)
        assert r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"]


def test_arima_recovers_an_autoregression(spark):
    rng = np.random.default_rng(11)
    y = [10.0]
    for e in rng.normal(0, 1, 1500):
        y.append(4 + 0.6 * y[-1] + e)
    got = forecast.arima(as_series(spark, y), IDS).orderBy("ds").collect()
    expected, level = [], y[-1]
    for _ in range(30):
        level = 4 + 0.6 * level
        expected.append(level)
    assert got[0]["order"].startswith("(") and ", 0, " in got[0]["order"] and len(got) == 30
    np.testing.assert_allclose([r["yhat"] for r in got], expected, atol=0.4)
    widths = [(r["yhat_upper"] - r["yhat_lower"]) / 2 / 1.96 for r in got]
    assert widths[0] == pytest.approx(1.0, abs=0.1) and widths[-1] == pytest.approx(1 / np.sqrt(1 - 0.36), abs=0.15)


def test_arima_differences_a_random_walk_with_drift_free_steps(spark):
    rng = np.random.default_rng(13)
    got = forecast.arima(as_series(spark, 100 + np.cumsum(rng.normal(0, 1, 800))), IDS).orderBy("ds").collect()
    widths = [r["yhat_upper"] - r["yhat_lower"] for r in got]
    assert all(b >= a for a, b in zip(widths, widths[1:])) and widths[-1] > 3 * widths[0]


def test_arima_on_constant_series_is_finite(spark):
    got = forecast.arima(as_series(spark, [5.0] * 60), IDS).collect()
    assert len(got) == 30 and all(r["yhat"] == pytest.approx(5.0, abs=1e-6) for r in got)


def test_comparison_marks_one_model_and_forecasts_are_not_negative(spark):
    rng = np.random.default_rng(17)
    weekly = np.tile([30, 31, 29, 30, 32, 5, 2], 20) + rng.normal(0, 0.5, 140)
    falling = 60 - 0.45 * np.arange(140) + rng.normal(0, 1, 140)
    df = as_series(spark, weekly, "weekly").union(as_series(spark, falling, "falling"))
    comparison, future = forecast.evaluate_and_forecast(df, IDS)
    chosen = {r["Metric"]: r["SelectedModel"] for r in forecast.selected_models(comparison, IDS).collect()}
    assert chosen["weekly"] in ("SeasonalNaive", "SeasonalRegression") and len(chosen) == 2
    assert comparison.count() == 8
    series.require_forecast_dates(future, df, IDS)
    assert future.where("yhat < 0 OR yhat_lower < 0 OR yhat_upper < 0").count() == 0
    assert future.where("Metric = 'falling' AND yhat = 0").count() > 0


def test_chart_frames(spark):
    history = as_series(spark, range(40))
    future = series.naive(history, IDS)
    both = series.history_and_forecast(history, future, IDS)
    assert both.count() == 70 and set(both.columns) == {"Metric", "Date", "Value", "Lower", "Upper", "Part"}
    dates = [r["Date"] for r in series.forecast_chart(future).collect()]
    assert dates == sorted(dates)


def test_the_daily_series_is_made_once(spark, capsys):
    """The decomposition checks its days and runs its windows on stored days, not on the line items."""
    QUERIES["f15_decomposition"](spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert "parquet" in plan and "lineitem" not in plan
