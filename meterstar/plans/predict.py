"""Forecast the master's daily measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.operators import forecast, series
from meterstar.session import materialise
from meterstar.sources.catalog import Catalog
from meterstar.sources.sinks import write_table
from meterstar.sources.star import load_master, reject_null_dates

REQUIRED = {"Date", "CostUSD", "TotalTokens", "UsageID"}
OUTPUTS = {"CostUSD": "cost forecast", "TotalTokens": "token forecast", "RequestCount": "request forecast"}


def run_forecasting(spark: SparkSession, out_dir: str, keys: Sequence[str] = (),
                    horizon: int = series.HORIZON) -> DataFrame:
    """Compare models on a holdout per series, forecast with the best, write all tables.

    Without ``keys`` there are three series, one per measure; with keys there
    are three per key value; those too short for a holdout are listed, with the
    reason, in a table of their own.
    """
    catalog = Catalog(spark, out_dir)
    master = reject_null_dates(load_master(spark, catalog.path("enriched master"), {*REQUIRED, *keys}))
    ids = [*keys, "Metric"]
    history = materialise(series.long_series(series.daily_usage(master, keys), keys))
    tables = f"{out_dir.rstrip('/')}/forecasts"
    if keys:
        history, left_out = series.part_short(history, ids, horizon)
        write_table(left_out, f"{tables}/series_left_out")
    comparison, future = forecast.evaluate_and_forecast(history, ids, horizon)
    future = materialise(future)
    series.require_forecast_dates(future, history.join(comparison.select(*ids).distinct(), ids, "left_semi"), ids, horizon)
    for metric, name in OUTPUTS.items():
        write_table(future.where(F.col("Metric") == metric), catalog.path(name))
    write_table(comparison, catalog.path("forecast model comparison"))
    write_table(comparison.where("Metric = 'RequestCount'"), f"{tables}/request_metrics")
    write_table(forecast.selected_models(comparison, ids), catalog.path("selected forecast models"))
    return future
