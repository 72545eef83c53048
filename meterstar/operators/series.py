"""Daily series: completion, splits, baseline forecasts, metrics, decomposition.

Many series are handled at once. A long frame has the series' id columns
(``ids``, the last one usually ``Metric``), ``ds`` and ``y``. Windows run per
series over its days, so a task holds a calendar, never raw requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterstar.functions import columns as C
from meterstar.operators.aggregates import keyed

HORIZON = 30
PERIOD = 7
METRICS = ("CostUSD", "TotalTokens", "RequestCount")
FORECAST_COLUMNS = ("ds", "yhat", "yhat_lower", "yhat_upper")


class ShortSeriesError(ValueError):
    """A series has too few days for the requested step."""


class ForecastDatesError(ValueError):
    """Forecast dates do not follow the history as they must."""


def daily_usage(usage: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Cost, tokens and requests per day, every day from a series' first to its last.

    Each day spans the gap to the next one, so missing days need no calendar
    join and no second pass.
    """
    daily = keyed(usage, "Date", *keys).groupBy(*keys, "Date").agg(
        C.total("CostUSD").alias("CostUSD"),
        C.total("TotalTokens").alias("TotalTokens"),
        F.count("UsageID").cast("double").alias("RequestCount"),
    )
    following = F.lead("Date").over(W.partitionBy(*keys).orderBy("Date"))
    gap = F.sequence("Date", F.coalesce(F.date_sub("_next", 1), F.col("Date")))
    filled = daily.withColumn("_next", following).withColumn("_day", F.explode(gap))
    observed = F.col("_day") == F.col("Date")
    return filled.select(
        *keys, F.col("_day").alias("Date"),
        *[F.when(observed, F.col(m)).otherwise(0.0).alias(m) for m in METRICS],
        C.is_weekend("_day").cast("int").alias("IsWeekend"),
    )


def long_series(daily: DataFrame, keys: Sequence[str] = (), metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row per series, metric and day."""
    cells = F.array(*[F.struct(F.lit(m).alias("Metric"), F.col(m).alias("y")) for m in metrics])
    return daily.select(*keys, F.col("Date").alias("ds"), F.explode(cells).alias("c")).select(*keys, "c.Metric", "ds", "c.y")


def _span(ids: Sequence[str]):
    return W.partitionBy(*ids)


def split_holdout(series: DataFrame, ids: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """Mark the last ``horizon`` days of each series as ``IsTest``.

    A series needs more than twice the horizon; a shorter one is an error (see ``part_short``).
    """
    marked = series.withColumn("IsTest", F.col("ds") > F.date_sub(F.max("ds").over(_span(ids)), horizon))
    require_days(series, ids, 2 * horizon + 1, "the holdout")
    return marked


def require_days(series: DataFrame, ids: Sequence[str], least: int, purpose: str) -> None:
    """Fail if any series has fewer than ``least`` days."""
    if not series.groupBy(*ids).count().where(F.col("count") < least).isEmpty():
        raise ShortSeriesError(f"at least {least} daily observations are required for {purpose}")


def part_short(series: DataFrame, ids: Sequence[str], horizon: int = HORIZON) -> tuple[DataFrame, DataFrame]:
    """The series long enough for a holdout, and one row with the reason for each other one."""
    sized = series.withColumn("_days", F.count(F.lit(1)).over(_span(ids)))
    enough = F.col("_days") > 2 * horizon
    short = sized.where(~enough).groupBy(*ids).agg(F.first("_days").alias("Days")).withColumn(
        "Reason", F.lit(f"fewer than {2 * horizon + 1} days"))
    return sized.where(enough).drop("_days"), short


def naive(train: DataFrame, ids: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """Repeat each series' last value; no interval."""
    last = train.groupBy(*ids).agg(F.max("ds").alias("_last"), F.max_by("y", "ds").alias("yhat"))
    return _with_steps(last, ids, horizon, F.col("yhat"))


def seasonal_naive(train: DataFrame, ids: Sequence[str], horizon: int = HORIZON, period: int = PERIOD) -> DataFrame:
    """Cycle each series' last ``period`` values; only for series of at least two periods."""
    newest = F.row_number().over(_span(ids).orderBy(F.desc("ds")))
    days = F.count(F.lit(1)).over(_span(ids))
    tail = train.withColumns({"_back": newest, "_days": days}).where(
        (F.col("_back") <= period) & (F.col("_days") >= 2 * period)
    )
    cycle = tail.groupBy(*ids).agg(
        F.max("ds").alias("_last"), F.array_sort(F.collect_list(F.struct("ds", "y"))).alias("_cycle")
    )
    value = F.element_at("_cycle", F.pmod(F.col("_step") - 1, F.lit(period)) + 1)["y"]
    return _with_steps(cycle, ids, horizon, value)


def _with_steps(per_series: DataFrame, ids: Sequence[str], horizon: int, value: Column) -> DataFrame:
    steps = future_days(per_series, horizon)
    none = F.lit(None).cast("double")
    return steps.select(*ids, "ds", value.alias("yhat"), none.alias("yhat_lower"), none.alias("yhat_upper"))


def future_days(per_series: DataFrame, horizon: int = HORIZON, last: str = "_last") -> DataFrame:
    """Repeat each series' row for the days after ``last``, as ``_step`` and ``ds``."""
    steps = per_series.withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.withColumn("ds", F.date_add(F.col(last), F.col("_step")))


def forecast_metrics(df: DataFrame, keys: Sequence[str], actual: str = "y", predicted: str = "yhat") -> DataFrame:
    """MAE, RMSE, MAPE and sMAPE per key.

    MAPE leaves out zero actuals and is NULL if all are zero; a day on which
    both values are zero counts as 0 in sMAPE.
    """
    a, p = F.col(actual), F.col(predicted)
    error, size = F.abs(a - p), F.abs(a) + F.abs(p)
    return df.groupBy(*keys).agg(
        F.avg(error).alias("MAE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        (F.avg(F.when(a != 0, error / F.nullif(a, F.lit(0.0)))) * 100).alias("MAPE"),
        (F.avg(F.when(size == 0, 0.0).otherwise(2 * error / F.nullif(size, F.lit(0.0)))) * 100).alias("sMAPE"),
    )


def check_forecast_dates(forecast: DataFrame, history: DataFrame, ids: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """Series whose forecast is not exactly ``horizon`` distinct days after their history."""
    last = history.groupBy(*ids).agg(F.max("ds").alias("_last"))
    found = forecast.groupBy(*ids).agg(
        F.count("ds").alias("Days"), F.count_distinct("ds").alias("DistinctDays"), F.min("ds").alias("FirstDay")
    )
    good = (F.col("Days") == horizon) & (F.col("DistinctDays") == horizon) & (F.col("FirstDay") > F.col("_last"))
    return last.join(found, list(ids), "left").where(~F.coalesce(good, F.lit(False)))


def require_forecast_dates(forecast: DataFrame, history: DataFrame, ids: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """Return ``forecast`` if every series passes ``check_forecast_dates``."""
    if not check_forecast_dates(forecast, history, ids, horizon).isEmpty():
        raise ForecastDatesError(f"a forecast must have exactly {horizon} distinct days after its history")
    return forecast


def decompose_weekly(series: DataFrame, ids: Sequence[str], period: int = PERIOD) -> DataFrame:
    """Additive trend, seasonal and residual parts per series; each needs at least 2*period+1 days.

    The trend is a centred moving average; its open ends continue the line
    through its first and last ``period`` points.
    """
    if period % 2 == 0:
        raise ValueError("the period must be odd, so that a centred average exists")
    require_days(series, ids, 2 * period + 1, "a decomposition")
    half = period // 2
    days = F.count(F.lit(1)).over(_span(ids))
    start = F.min("ds").over(_span(ids))
    by_day = _span(ids).orderBy("_t")
    around = by_day.rowsBetween(-half, half)
    base = series.withColumns({"_n": days, "_t": F.datediff("ds", start)})
    inner = F.col("_t").between(half, F.col("_n") - 1 - half)
    base = base.withColumn("_mid", F.when(inner, F.avg("y").over(around)))
    head = F.col("_t").between(half, half + period - 1)
    tail = F.col("_t").between(F.col("_n") - half - period, F.col("_n") - 1 - half)
    lines = {}
    for name, part in (("h", head), ("l", tail)):
        x, y = F.when(part, F.col("_t")), F.when(part, F.col("_mid"))
        lines[f"_{name}_slope"] = F.regr_slope(y, x).over(_span(ids))
        lines[f"_{name}_base"] = F.regr_intercept(y, x).over(_span(ids))
    base = base.withColumns(lines)
    trend = (
        F.when(F.col("_t") < half, F.col("_h_base") + F.col("_h_slope") * F.col("_t"))
        .when(F.col("_mid").isNotNull(), F.col("_mid"))
        .otherwise(F.col("_l_base") + F.col("_l_slope") * F.col("_t"))
    )
    base = base.withColumn("Trend", trend).withColumn("_phase", F.pmod("_t", F.lit(period)))
    base = base.withColumn("_effect", F.avg(F.col("y") - F.col("Trend")).over(W.partitionBy(*ids, "_phase")))
    # The mean effect counts each phase once: it is read off the first period.
    centre = F.avg(F.when(F.col("_t") < period, F.col("_effect"))).over(_span(ids))
    base = base.withColumn("Seasonal", F.col("_effect") - centre)
    return base.select(
        *ids, "ds", F.col("y").alias("Observed"), "Trend", "Seasonal",
        (F.col("y") - F.col("Trend") - F.col("Seasonal")).alias("Residual"),
    )


def unit_root_statistic(series: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Dickey-Fuller t statistic (constant, no lagged differences) per series."""
    previous = F.lag("y").over(_span(ids).orderBy("ds"))
    steps = series.withColumn("_x", previous).withColumn("_d", F.col("y") - F.col("_x")).where("_x IS NOT NULL")
    slope = F.regr_slope("_d", "_x")
    sse = F.regr_syy("_d", "_x") - slope * F.regr_sxy("_d", "_x")
    error = F.sqrt(C.ratio(C.ratio(sse, F.regr_count("_d", "_x") - 2), F.regr_sxx("_d", "_x")))
    return steps.groupBy(*ids).agg(
        F.regr_count("_d", "_x").alias("Observations"), C.ratio(slope, error).alias("DickeyFullerT")
    )


def forecast_chart(forecast: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """Forecast and interval by date, in date order."""
    return forecast.select(*ids, F.to_date("ds").alias("Date"), "yhat", "yhat_lower", "yhat_upper").orderBy(*ids, "Date")


def history_and_forecast(history: DataFrame, forecast: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """History (``ds``, ``y``) and forecast as one frame: Date, Value, Lower, Upper."""
    past = history.select(*ids, F.to_date("ds").alias("Date"), F.col("y").alias("Value"), F.lit("history").alias("Part"))
    future = forecast.select(
        *ids, F.to_date("ds").alias("Date"), F.col("yhat").alias("Value"),
        F.col("yhat_lower").alias("Lower"), F.col("yhat_upper").alias("Upper"), F.lit("forecast").alias("Part"),
    )
    return past.unionByName(future, allowMissingColumns=True)
