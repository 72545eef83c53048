"""Seasonal regression on a piecewise-linear trend whose breaks are found by an L1 penalty.

Each series is reduced to the products of its regressors (one grouped aggregate over its days); the penalised fit is
coordinate descent on that small matrix, and the interval comes from simulated future breaks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.functions.holidays import is_us_holiday
from meterstar.operators import series as S
from meterstar.operators.least_squares import normal_equations, system
from meterstar.session import ship_package

# Usual settings of such a model: candidate breaks, the share of the history they lie in, the scale of their
# changes (of the series' largest value, over the whole history), and the scales of trend and effects.
BREAKS, BREAK_SHARE, BREAK_SCALE = 25, 0.8, 0.05
TREND_SCALE, EFFECT_SCALE = 5.0, 10.0
DRAWS, LEVEL = 1000, 0.95
SEED = 20
PLAIN = 9              # columns before the breaks: level, slope, six weekdays, holiday
SWEEPS, NOISE_ROUNDS = 20_000, 60
_TOLERANCE = 1e-9


def _design(ds: str, start: Column, span: Column, breaks: Sequence[Column]) -> list[Column]:
    """Level, slope, weekdays, holiday, and the slope after each break; time runs from 0 to 1 over the history."""
    # Six weekday indicators: the weekend indicator is their sum, so it adds nothing.
    weekdays = [(F.weekday(ds) == d).cast("double") for d in range(1, 7)]
    time = F.datediff(F.col(ds), start) / span
    return [F.lit(1.0), time, *weekdays, is_us_holiday(ds).cast("double"), *[F.greatest(time - b, F.lit(0.0)) for b in breaks]]


def _breaks(days: Column, span: Column, count: int) -> list[Column]:
    """Break times, evenly over the first days; a short series has some of them at the same place, which share their change."""
    most = F.floor(days * BREAK_SHARE) - 1
    return [F.round(most * (i / count)) / span for i in range(1, count + 1)]


def penalised(gram: np.ndarray, cross: np.ndarray, weight: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Minimise b'Gb/2 - c'b + sum(weight |b|) by coordinate descent; columns without weight have been solved out before.

    One coordinate moves at a time to its exact minimum, until a whole sweep moves nothing.
    """
    b = start.copy()
    slope = cross - gram @ b
    size = np.diag(gram)
    limit = _TOLERANCE * max(float(np.abs(cross).max(initial=0.0)), float(weight.max(initial=0.0)), 1e-300)
    active = np.flatnonzero(size > 1e-12 * max(size.max(initial=0.0), 1e-300))
    b[np.setdiff1d(np.arange(len(b)), active)] = 0.0
    slope = cross - gram @ b
    for _ in range(SWEEPS):
        most = 0.0
        for j in active:
            pull = slope[j] + size[j] * b[j]
            new = np.sign(pull) * max(abs(pull) - weight[j], 0.0) / size[j]
            moved = new - b[j]
            if moved:
                slope -= gram[:, j] * moved
                b[j] = new
                most = max(most, abs(moved) * size[j])
        if most <= limit:
            break
    return b


def break_fit(upper: Sequence[float], days: int, largest: float) -> tuple[np.ndarray, float]:
    """Coefficients and noise (both in the series' units) of one series, the most probable ones under the priors.

    Changes of slope have a Laplace prior, all else a wide normal one, and the
    noise is estimated along: the penalty in the least-squares problem is the
    noise variance over the prior's scale, so fit and noise are found in turns.
    """
    gram, cross, square = system(upper)
    scale = largest or 1.0
    cross, square = cross / scale, square / scale**2
    wide = np.full(PLAIN, EFFECT_SCALE)
    wide[:2] = TREND_SCALE
    k = len(cross) - PLAIN
    change, noise = np.zeros(k), max(square / days, 1e-18)
    beta = np.zeros(len(cross))
    for _ in range(NOISE_ROUNDS):
        # The plain columns are solved out, so that the descent sees the breaks alone.
        own = gram[:PLAIN, :PLAIN] + np.diag(noise / wide**2)
        unit = np.sqrt(np.diag(own))
        inverse = np.linalg.pinv(own / np.outer(unit, unit), rcond=1e-11, hermitian=True) / np.outer(unit, unit)
        side = gram[PLAIN:, :PLAIN] @ inverse
        reduced = gram[PLAIN:, PLAIN:] - side @ gram[:PLAIN, PLAIN:]
        change = penalised(reduced, cross[PLAIN:] - side @ cross[:PLAIN], np.full(k, noise / BREAK_SCALE), change) if k else change
        beta = np.concatenate([inverse @ (cross[:PLAIN] - gram[:PLAIN, PLAIN:] @ change), change])
        left = max(square - 2 * beta @ cross + beta @ gram @ beta, 0.0) / days
        settled = abs(left - noise) <= 1e-9 * noise
        noise = max(left, 1e-14 * square / days, 1e-18)
        if settled:
            break
    return beta * scale, float(np.sqrt(noise)) * scale


def margins(change: np.ndarray, noise: float, span: int, horizon: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper quantile of what noise and future breaks add to each forecast day.

    Future breaks are as frequent as the candidates in the history, and change
    the slope by Laplace amounts as large as the fitted ones on average. All series share their draws.
    """
    rng = np.random.default_rng(seed)
    happens = rng.random((DRAWS, horizon)) < min(len(change) / max(span, 1), 1.0)
    sizes = rng.laplace(0.0, 1.0, (DRAWS, horizon)) * happens
    trend = np.cumsum(np.cumsum(sizes, axis=1), axis=1)      # a change of slope adds up day by day
    size = float(np.abs(change).mean()) if len(change) else 0.0
    total = size / max(span, 1) * trend + noise * rng.standard_normal((DRAWS, horizon))
    low, high = np.quantile(total, [(1 - LEVEL) / 2, (1 + LEVEL) / 2], axis=0)
    return low, high


_FIT = T.StructType([T.StructField("beta", T.ArrayType(T.DoubleType())), T.StructField("noise", T.DoubleType()),
                     T.StructField("low", T.ArrayType(T.DoubleType())), T.StructField("high", T.ArrayType(T.DoubleType()))])


def trend_models(train: DataFrame, ids: Sequence[str], horizon: int = S.HORIZON, breaks: int = BREAKS) -> DataFrame:
    """The fit of each series: ``beta`` (level, slope, weekdays, holiday, changes of slope), ``noise``, interval ends, ``_start``, ``_last``."""
    ship_package(train.sparkSession)
    ends = train.groupBy(*ids).agg(F.min("ds").alias("_start"), F.max("ds").alias("_last"), F.count(F.lit(1)).alias("_days"))
    renamed = ends.withColumnsRenamed({c: f"_e_{c}" for c in ids})
    same = [F.col(c).eqNullSafe(F.col(f"_e_{c}")) for c in ids]
    framed = train.join(renamed, same).drop(*[f"_e_{c}" for c in ids])
    span = F.greatest(F.datediff("_last", "_start"), F.lit(1)).cast("double")
    xs = _design("ds", F.col("_start"), span, _breaks(F.col("_days"), span, breaks))
    sums = normal_equations(framed, [*ids, "_start", "_last", "_days"], xs, F.col("y"), {"_largest": F.max(F.abs("y"))})

    @F.pandas_udf(_FIT)
    def fitted(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for upper, days, largest, length in batches:
            rows = []
            for one in zip(upper, days, largest, length):
                beta, noise = break_fit(*one[:3])
                low, high = margins(beta[PLAIN:], noise, one[3], horizon)
                rows.append((beta.tolist(), noise, low.tolist(), high.tolist()))
            yield pd.DataFrame(rows, columns=["beta", "noise", "low", "high"])

    return sums.withColumn("_fit", fitted("sums", "_days", "_largest", span.cast("int"))).select(*ids, "_start", "_last", "_days", "_fit.*")


def seasonal_regression(train: DataFrame, ids: Sequence[str], horizon: int = S.HORIZON, breaks: int = BREAKS) -> DataFrame:
    """Trend with breaks, weekday and US-holiday effects per series, with a 95 % interval that widens with the horizon."""
    models = trend_models(train, ids, horizon, breaks)
    future = S.future_days(models, horizon)
    span = F.greatest(F.datediff("_last", "_start"), F.lit(1)).cast("double")
    xs = _design("ds", F.col("_start"), span, _breaks(F.col("_days"), span, breaks))
    yhat = sum((F.col("beta")[i] * x.cast("double") for i, x in enumerate(xs)), F.lit(0.0))
    at = F.col("_step") - 1
    return future.select(*ids, "ds", yhat.alias("yhat"), (yhat + F.get("low", at)).alias("yhat_lower"), (yhat + F.get("high", at)).alias("yhat_upper"))
