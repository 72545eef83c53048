"""Registered: daily series and forecasts, per region and measure."""

from pyspark.sql import functions as F

from checks.registry import register, rounded, shipped
from meterstar.operators import arima, forecast, series, trend
from meterstar.session import materialise

KEYS = ["RegionName"]
IDS = [*KEYS, "Metric"]


def regional_daily(spark, sf_dir):
    # Written, because checks and windows read it more than once.
    return materialise(series.daily_usage(shipped(spark, sf_dir, "region"), KEYS))


def regional_series(spark, sf_dir):
    return series.long_series(regional_daily(spark, sf_dir), KEYS)


def training(spark, sf_dir):
    return series.split_holdout(regional_series(spark, sf_dir), IDS).where(~F.col("IsTest"))


@register("f1_daily_calendar")
def _(spark, sf_dir):
    return rounded(regional_daily(spark, sf_dir))


@register("f2_holdout_split")
def _(spark, sf_dir):
    marked = series.split_holdout(regional_series(spark, sf_dir), IDS)
    return rounded(marked)


@register("f3_naive")
def _(spark, sf_dir):
    return rounded(series.naive(training(spark, sf_dir), IDS).select(*IDS, "ds", "yhat"))


@register("f4_seasonal_naive")
def _(spark, sf_dir):
    return rounded(series.seasonal_naive(training(spark, sf_dir), IDS).select(*IDS, "ds", "yhat"))


@register("f5_f11_model_comparison")
def _(spark, sf_dir):
    return rounded(forecast.compare_models(
        materialise(regional_series(spark, sf_dir)), IDS, models=["Naive", "SeasonalNaive"]
    ))


@register("f11_all_models")
def _(spark, sf_dir):
    return rounded(forecast.compare_models(materialise(regional_series(spark, sf_dir)), IDS))


@register("f6_arima")
def _(spark, sf_dir):
    return rounded(forecast.arima(materialise(regional_series(spark, sf_dir)), IDS))


@register("f6_arima_models")
def _(spark, sf_dir):
    """Order, coefficients and likelihoods (of the fit, and of its least-squares start) per series."""
    found = arima.arima_models(materialise(regional_series(spark, sf_dir)), IDS)
    return rounded(found.select(*IDS, "p", "d", "q", "phi", "theta", "mean", "sigma2", "loglik", "least_squares_loglik", "aic", "bic"))


@register("f6_arima_methods")
def _(spark, sf_dir):
    """Holdout errors of the exact and of the least-squares fit."""
    return rounded(forecast.compare_models(
        materialise(regional_series(spark, sf_dir)), IDS, models=["ARIMA", "LeastSquaresARIMA"]
    ))


@register("f7_trend_breaks")
def _(spark, sf_dir):
    """Changes of slope of each series' trend, by the day of the break."""
    found = trend.trend_models(materialise(regional_series(spark, sf_dir)), IDS)
    day = F.round((F.floor(F.col("_days") * trend.BREAK_SHARE) - 1) * (F.col("at") + 1) / trend.BREAKS).cast("int")
    changes = found.select("*", F.posexplode(F.slice("beta", trend.PLAIN + 1, trend.BREAKS)).alias("at", "change")).where("change <> 0")
    return rounded(changes.select(*IDS, F.date_add("_start", day).alias("ds"), "change", "noise"))


@register("f7_seasonal_regression")
def _(spark, sf_dir):
    return rounded(forecast.seasonal_regression(regional_series(spark, sf_dir), IDS))


@register("f10_forecast_dates")
def _(spark, sf_dir):
    """Forecasts of one measure are a day short, so its series must be reported."""
    history = regional_series(spark, sf_dir)
    tokens = F.col("Metric") == "TotalTokens"
    forecasts = series.naive(history.where(~tokens), IDS).union(series.naive(history.where(tokens), IDS, horizon=29))
    return series.check_forecast_dates(forecasts, history, IDS)


@register("f12_selected_forecast")
def _(spark, sf_dir):
    comparison, future = forecast.evaluate_and_forecast(regional_series(spark, sf_dir), IDS)
    return rounded(future)


@register("f14_history_and_forecast")
def _(spark, sf_dir):
    history = regional_series(spark, sf_dir)
    return rounded(series.history_and_forecast(history, series.naive(history, IDS), IDS))


@register("f15_decomposition")
def _(spark, sf_dir):
    requests = regional_series(spark, sf_dir).where("Metric = 'RequestCount'")
    return rounded(series.decompose_weekly(requests, IDS))


@register("f16_unit_root")
def _(spark, sf_dir):
    return rounded(series.unit_root_statistic(regional_series(spark, sf_dir), IDS))


@register("f16_unit_root_test")
def _(spark, sf_dir):
    return rounded(forecast.unit_root_test(materialise(regional_series(spark, sf_dir)), IDS))
