"""ARIMA by exact Gaussian likelihood: a Kalman filter over many series and orders at once.

A series is one row (its days in order), so a task filters a block of series
together, each with all orders (and all steps of the gradient) side by side: the loop
over days is the only one.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.operators import series as S
from meterstar.session import ship_package

NORMAL_95 = 1.959963984540054
MAX_P, MAX_Q, MAX_D = 2, 2, 1
ORDERS = tuple(itertools.product(range(MAX_P + 1), range(MAX_D + 1), range(MAX_Q + 1)))
START = 4               # days that every order is conditioned on, so that all are judged on the same days
DIFFUSE = 1e6           # variance of the state before the first day, in shock variances
EDGE = 1.05             # roots of the autoregression may be this far outside the stationary region
ROUNDS = 25
LONG_LAGS = 7
BLOCK = 16              # series filtered together
LEAST_DAYS = LONG_LAGS + MAX_Q + 2
_STEP = 1e-4


def coefficients(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phi, theta) of free parameters (..., 4): theta is always invertible, phi at most ``EDGE`` beyond stationarity."""
    bent = np.tanh(x)
    phi2 = EDGE * bent[..., 1]
    phi1 = EDGE * bent[..., 0] * (1 - bent[..., 1])
    return np.stack([phi1, phi2], -1), np.stack([bent[..., 2] * (1 + bent[..., 3]), bent[..., 3]], -1)


def free_parameters(phi: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """The parameters nearest to the given coefficients, inside the allowed region."""
    inside = 1 - 1e-3
    b = np.clip(phi[..., 1] / EDGE, -inside, inside)
    a = np.clip(phi[..., 0] / EDGE / (1 - b), -inside, inside)
    d = np.clip(theta[..., 1], -inside, inside)
    c = np.clip(theta[..., 0] / (1 + d), -inside, inside)
    return np.arctanh(np.stack([a, b, c, d], -1))


@dataclass
class Filtered:
    """What a pass over the days leaves, per lane."""

    objective: np.ndarray   # -2 log likelihood without constants
    errors: np.ndarray      # standardised one-step errors, (days, lanes)
    mean: np.ndarray
    sigma2: np.ndarray
    loglik: np.ndarray
    state: np.ndarray       # prediction of the next day's state, (3, lanes), of the values less the mean
    spread: np.ndarray      # its variance in shock variances, (3, 3, lanes)


def kalman(z: np.ndarray, days: np.ndarray, skipped: np.ndarray, with_mean: np.ndarray, x: np.ndarray) -> Filtered:
    """Filter lanes of values ``z`` (days, lanes), each ``days`` long; lanes with ``with_mean`` estimate their mean.

    The state is (value, what the last two shocks and values still add to the
    next one and the one after), so a value seen makes the state's first part exact. The start
    is diffuse, and the first ``skipped`` values only fix it. The mean and the
    shock variance have closed forms given the rest: the mean by running a column of ones through the same filter.
    """
    n, lanes = z.shape
    phi, theta = coefficients(x)
    (f1, f2), (t1, t2) = phi.T, theta.T
    c12, c22, t2s = t1 * t2, t1 * t1, t2 * t2
    ones = with_mean.astype(float)
    p11, p12, p13 = np.full(lanes, DIFFUSE), np.zeros(lanes), np.zeros(lanes)
    p22, p23, p33 = np.full(lanes, DIFFUSE), np.zeros(lanes), np.full(lanes, DIFFUSE)
    a = np.zeros((2, 2, lanes))                    # first and second part, of values and of ones
    errors = np.zeros((2, n, lanes))
    logs = np.zeros(lanes)
    end = [np.zeros((2, 2, lanes)), np.zeros((3, lanes))]
    value = np.empty((2, lanes))
    value[1] = ones
    shortest = int(days.min())
    for t in range(n):
        if t >= shortest:                          # a lane keeps the state after its last day
            done = days == t
            if done.any():
                end[0][:, :, done] = a[:, :, done]
                end[1][:, done] = np.stack([p11, p12, p22])[:, done]
        value[0] = z[t]
        v = value - a[0]
        counts = (t >= skipped) & (t < days)
        errors[:, t] = np.where(counts, v / np.sqrt(p11), 0.0)
        logs += np.where(counts, np.log(p11), 0.0)
        gain2, gain3 = p12 / p11, p13 / p11
        second = a[1] + gain2 * v
        a = np.stack([f1 * value + second, f2 * value + gain3 * v])
        b22, b23, b33 = p22 - gain2 * p12, p23 - gain2 * p13, p33 - gain3 * p13
        p11, p12, p13, p22, p23, p33 = b22 + 1, b23 + t1, t2, b33 + c22, c12, t2s
    done = days == n
    end[0][:, :, done] = a[:, :, done]
    end[1][:, done] = np.stack([p11, p12, p22])[:, done]
    own, unit = errors
    weight = (unit * unit).sum(0)
    mean = np.where(with_mean & (weight > 0), (own * unit).sum(0) / np.where(weight > 0, weight, 1), 0.0)
    errors = own - mean * unit
    used = days - skipped
    square = (errors * errors).sum(0)
    sigma2 = np.maximum(square / used, 1e-18)
    objective = used * np.log(sigma2) + logs
    first, middle = end[0][0, 0] - mean * end[0][0, 1], end[0][1, 0] - mean * end[0][1, 1]
    q11, q12, q22 = end[1]
    zero = np.zeros(lanes)
    spread = np.array([[q11, q12, t2], [q12, q22, c12], [t2, c12, t2s]])
    return Filtered(objective, errors, mean, sigma2, -0.5 * (objective + used * (np.log(2 * np.pi) + 1)),
                    np.stack([first, middle, zero]), spread)


def _start_values(z: np.ndarray) -> np.ndarray:
    """Two-stage least squares of one series for every (p, q): free parameters, (p, q, 4)."""
    out = np.zeros((MAX_P + 1, MAX_Q + 1, 4))
    z = z - z.mean()
    m = len(z)
    lagged = np.stack([z[LONG_LAGS - i:m - i] for i in range(1, LONG_LAGS + 1)], 1)
    shocks = z[LONG_LAGS:] - lagged @ np.linalg.lstsq(lagged, z[LONG_LAGS:], rcond=1e-9)[0]
    rows = len(shocks) - MAX_Q
    columns = [z[m - rows - i:m - i] for i in (1, 2)] + [shocks[MAX_Q - i:len(shocks) - i] for i in (1, 2)]
    for p in range(MAX_P + 1):
        for q in range(MAX_Q + 1):
            use = [*range(p), *range(2, 2 + q)]
            own = np.zeros(4)
            if use:
                own[use] = np.linalg.lstsq(np.stack([columns[i] for i in use], 1), z[m - rows:], rcond=1e-9)[0]
            out[p, q] = free_parameters(own[:2], own[2:])
            out[p, q][[i for i in range(4) if i not in use]] = 0.0
    return out


def fit_block(values: Sequence[np.ndarray], orders: Sequence[tuple[int, int, int]] = ORDERS) -> tuple[Filtered, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximise the likelihood of every order of every series; lanes are series by series, in the order given.

    Returns the last filter pass, the parameters, the scales, and -2 log likelihood at the least-squares start and at the end. Steps
    are damped Gauss-Newton on the standardised errors, with the exact
    objective's gradient; a step is taken only if the likelihood rises, so it never ends below
    its start, the better of the least-squares fit and no dynamics at all.
    """
    count, per = len(values), len(orders)
    lanes = count * per
    longest = max(map(len, values))
    z, days, starts = np.zeros((longest, lanes)), np.zeros(lanes, np.int64), np.zeros((lanes, 4))
    scales = np.ones(lanes)
    for i, own in enumerate(values):
        for d in sorted({o[1] for o in orders}):
            moved = np.diff(own, n=d)
            scale = float(np.std(moved)) or 1.0
            centred = moved / scale
            guess = _start_values(centred)
            for k, (p, od, q) in enumerate(orders):
                if od == d:
                    lane = i * per + k
                    z[:len(centred), lane], days[lane], scales[lane], starts[lane] = centred, len(centred), scale, guess[p, q]
    d = np.tile([o[1] for o in orders], count)
    skipped, with_mean = START - d, d == 0
    free = np.tile([[p > 0, p > 1, q > 0, q > 1] for p, _, q in orders], (count, 1))

    def run(x: np.ndarray, at: np.ndarray) -> Filtered:
        return kalman(z[:, at], days[at], skipped[at], with_mean[at], x)

    every = np.arange(lanes)
    least_squares, still = run(starts, every).objective, run(np.zeros_like(starts), every).objective
    x = np.where((least_squares <= still)[:, None], starts, 0.0)
    best, damping = np.minimum(least_squares, still), np.full(lanes, 1e-3)
    open_ = np.flatnonzero(free.any(1))
    for _ in range(ROUNDS):
        if not len(open_):
            break
        m = len(open_)
        shifts = np.concatenate([np.zeros((1, 4)), _STEP * np.eye(4), -_STEP * np.eye(4)])
        tried = (x[open_] + shifts[:, None, :] * free[open_]).reshape(-1, 4)
        seen = run(tried, np.tile(open_, 9))
        objective, errors = seen.objective.reshape(9, m), seen.errors.reshape(-1, 9, m)
        slope = ((objective[1:5] - objective[5:]) / (2 * _STEP)).T
        jacobian = (errors[:, 1:5] - errors[:, 5:]) / (2 * _STEP)
        curve = 2 * np.einsum("tim,tjm->mij", jacobian, jacobian) / seen.sigma2.reshape(9, m)[0][:, None, None]
        fixed = ~free[open_]
        curve[np.broadcast_to(fixed[:, :, None] | fixed[:, None, :], curve.shape)] = 0.0
        size = np.maximum(np.einsum("mii->mi", curve), 1e-8)
        step = np.linalg.solve(curve + np.einsum("mi,ij->mij", size * damping[open_][:, None] + 1e-9 + fixed, np.eye(4)), -slope[..., None])[..., 0]
        step = np.clip(step, -1.0, 1.0) * free[open_]
        there = np.clip(x[open_] + step, -6.0, 6.0)
        reached = run(there, open_).objective
        better = reached < best[open_]
        gain = np.where(better, best[open_] - reached, 0.0)
        x[open_[better]], best[open_[better]] = there[better], reached[better]
        damping[open_] = np.where(better, damping[open_] / 10, damping[open_] * 10)
        open_ = open_[(better & (gain > 1e-7)) | (~better & (damping[open_] < 1e4))]
    return run(x, every), x, scales, least_squares, best


def _path(last: float, d: int, mean: float, sigma2: float, state: np.ndarray, spread: np.ndarray, x: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts and their standard errors; with d = 1 the steps add up from the last value."""
    (f1, f2), (t1, t2) = coefficients(x)
    move = np.array([[f1, 1, 0], [f2, 0, 1], [0, 0, 0]])
    shock = np.array([1, t1, t2])
    whole, onward = np.zeros((4, 4)), np.zeros((4, 4))
    whole[1:, 1:] = spread                         # level so far, then the state
    onward[0, 0], onward[0, 1], onward[1:, 1:] = 1, 1, move
    noise = np.outer([0, *shock], [0, *shock])
    seen = np.array([1.0, 1, 0, 0]) if d else np.array([0.0, 1, 0, 0])
    at = np.array([last if d else 0.0, *state])
    points, errors = np.zeros(steps), np.zeros(steps)
    for h in range(steps):
        points[h] = seen @ at + mean
        errors[h] = np.sqrt(max(sigma2 * (seen @ whole @ seen), 0.0))
        at, whole = onward @ at, onward @ whole @ onward.T + noise
    return points, errors


_MODEL = ("p int, d int, q int, phi array<double>, theta array<double>, mean double, sigma2 double, loglik double, least_squares_loglik double, "
          "aic double, bic double, yhat array<double>, error array<double>")


def best_models(values: Sequence[np.ndarray], steps: int, orders: Sequence[tuple[int, int, int]] = ORDERS) -> pd.DataFrame:
    """Per series the order with the smallest (BIC, AIC), its fit and its forecasts."""
    rows = []
    for start in range(0, len(values), BLOCK):
        some = values[start:start + BLOCK]
        end, x, scales, first, best = fit_block(some, orders)
        phi, theta = coefficients(x)
        for i, own in enumerate(some):
            used = len(own) - START
            found = []
            for k, (p, d, q) in enumerate(orders):
                lane = i * len(orders) + k
                scaled = end.loglik[lane] - used * np.log(scales[lane])
                params = p + q + (d == 0) + 1
                found.append((params * np.log(used) - 2 * scaled, 2 * params - 2 * scaled, d, p, q, lane, scaled))
            bic, aic, d, p, q, lane, scaled = min(found)
            scale = scales[lane]
            points, errors = _path(own[-1] / scale, d, end.mean[lane], end.sigma2[lane], end.state[:, lane], end.spread[..., lane], x[lane], steps)
            rows.append((p, d, q, phi[lane][:p].tolist(), theta[lane][:q].tolist(), end.mean[lane] * scale, end.sigma2[lane] * scale**2, scaled,
                         scaled - 0.5 * (first[lane] - best[lane]), aic, bic, (points * scale).tolist(), (errors * scale).tolist()))
    return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _MODEL.split(", ")])


def arima_models(train: DataFrame, ids: Sequence[str], horizon: int = S.HORIZON) -> DataFrame:
    """The chosen ARIMA model of each series: order, coefficients, likelihoods, and forecasts with standard errors.

    Orders p, q up to 2 and d up to 1 by (BIC, AIC), each fitted by exact likelihood with a diffuse start. A series' days are
    gathered in one row, a few numbers a day; series are dealt over all tasks.
    """
    S.require_days(train, ids, LEAST_DAYS, "ARIMA")
    spark = train.sparkSession
    ship_package(spark)
    rows = train.groupBy(*ids).agg(F.sort_array(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y")))).alias("_days"))
    rows = rows.select(*ids, F.element_at("_days", -1)["ds"].alias("_last"), F.col("_days.y").alias("_y"))

    @F.pandas_udf(_MODEL)
    def fitted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield best_models([np.asarray(y, float) for y in batch], horizon)

    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *ids)
    return dealt.withColumn("_m", fitted("_y")).select(*ids, "_last", "_m.*")


def arima(train: DataFrame, ids: Sequence[str], horizon: int = S.HORIZON) -> DataFrame:
    """ARIMA forecasts with 95 % intervals; see ``arima_models``."""
    steps = arima_models(train, ids, horizon).select("*", F.posexplode(F.arrays_zip("yhat", "error")).alias("_at", "_f"))
    margin = F.col("_f.error") * NORMAL_95
    return steps.select(
        *ids, F.date_add("_last", F.col("_at") + 1).alias("ds"), F.col("_f.yhat").alias("yhat"),
        (F.col("_f.yhat") - margin).alias("yhat_lower"), (F.col("_f.yhat") + margin).alias("yhat_upper"),
        F.format_string("(%d, %d, %d)", "p", "d", "q").alias("order"),
    )
