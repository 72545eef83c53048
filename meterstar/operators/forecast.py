"""Model forecasts for many series: comparison, selection, least-squares ARIMA, unit-root test.

Least-squares fits are grouped aggregates of products (the normal equations); only the
small per-series systems are solved in Python, one row per series. Exact-likelihood ARIMA is in ``arima``, the
regression with a broken trend in ``trend``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.operators import series as S
from meterstar.operators.arima import arima
from meterstar.operators.least_squares import grouped_ols, normal_equations, solve, system
from meterstar.operators.trend import seasonal_regression
from meterstar.session import materialise, ship_package

NORMAL_95 = 1.959963984540054
LONG_LAGS = 7          # lags of the first-stage autoregression that estimates the shocks
MAX_P, MAX_Q = 2, 2    # largest orders searched; differencing 0 or 1
_NUMBERS = T.ArrayType(T.DoubleType())
MODELS = ("Naive", "SeasonalNaive", "ARIMA", "SeasonalRegression")


def _dot(beta: str, xs: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(beta)[i] * x.cast("double") for i, x in enumerate(xs)])


# --- ARIMA by two-stage least squares -------------------------------------------------

_ORDER = T.StructType([
    T.StructField("p", T.IntegerType()), T.StructField("d", T.IntegerType()), T.StructField("q", T.IntegerType()),
    T.StructField("beta", _NUMBERS), T.StructField("sigma2", T.DoubleType()),
    T.StructField("aic", T.DoubleType()), T.StructField("bic", T.DoubleType()),
])
_PATH = T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in ("yhat", "lower", "upper")]))


@F.pandas_udf(_ORDER)
def _best_order(sums: pd.Series, n: pd.Series, d: pd.Series) -> pd.DataFrame:
    """Best (p, q) by (BIC, AIC) for one differencing; all fits share one product matrix."""
    rows = []
    for upper, size, diff in zip(sums, n, d):
        full, cross, square = system(upper)
        best = None
        for p in range(MAX_P + 1):
            for q in range(MAX_Q + 1):
                # Columns: constant (only undifferenced), lags of the value, lags of the shock.
                use = ([0] if diff == 0 else []) + list(range(1, 1 + p)) + list(range(1 + MAX_P, 1 + MAX_P + q))
                beta, sse = solve(full[np.ix_(use, use)], cross[use], square) if use else (np.array([]), square)
                sigma2 = max(sse / size, 1e-12 * square / size, 1e-300)
                loglik = -0.5 * size * (np.log(2 * np.pi * sigma2) + 1)
                params = len(use) + 1
                aic, bic = 2 * params - 2 * loglik, params * np.log(size) - 2 * loglik
                if best is None or (bic, aic) < (best[6], best[5]):
                    weights = np.zeros(len(cross))
                    weights[use] = beta
                    best = (p, int(diff), q, weights.tolist(), sigma2, aic, bic)
        rows.append(best)
    return pd.DataFrame(rows, columns=["p", "d", "q", "beta", "sigma2", "aic", "bic"])


@F.pandas_udf(_PATH)
def _project(beta: pd.Series, d: pd.Series, sigma2: pd.Series, tail: pd.Series, horizon: pd.Series) -> pd.Series:
    """Recursive forecast from the last values and shocks, with psi-weight intervals."""
    out = []
    for weights, diff, variance, state, steps in zip(beta, d, sigma2, tail, horizon):
        constant, phi, theta = weights[0], np.asarray(weights[1:1 + MAX_P]), np.asarray(weights[1 + MAX_P:])
        level, values, shocks = state[0], list(state[1:1 + MAX_P]), list(state[1 + MAX_P:])
        impulse = np.zeros(steps)
        points, total = [], level
        for h in range(steps):
            z = constant + phi @ values + theta @ shocks
            values, shocks = [z, *values[:-1]], [0.0, *shocks[:-1]]
            total = total + z if diff else z
            points.append(total)
            impulse[h] = (1.0 if h == 0 else 0.0) + sum(phi[i] * impulse[h - 1 - i] for i in range(MAX_P) if h > i)
            impulse[h] += theta[h - 1] if 0 < h <= MAX_Q else 0.0
        psi = np.cumsum(impulse) if diff else impulse
        margin = NORMAL_95 * np.sqrt(variance * np.cumsum(psi**2))
        out.append([{"yhat": y, "lower": y - m, "upper": y + m} for y, m in zip(points, margin)])
    return pd.Series(out)


def least_squares_arima(train: DataFrame, ids: Sequence[str], horizon: int = S.HORIZON) -> DataFrame:
    """ARIMA forecasts with 95 % intervals, without a likelihood search; orders p, q up to 2 and d up to 1 by (BIC, AIC).

    Two-stage least squares (Hannan and Rissanen): a long autoregression
    estimates the shocks, a regression on lagged values and shocks the model.
    Both differencings of every series are fitted side by side.
    """
    S.require_days(train, ids, LONG_LAGS + MAX_Q + 2, "ARIMA")
    by = [*ids, "d"]
    order = W.partitionBy(*by).orderBy("ds")
    both = train.select(*ids, "ds", "y", F.explode(F.array(F.lit(0), F.lit(1))).alias("d"))
    both = both.withColumn("z", F.when(F.col("d") == 0, F.col("y")).otherwise(F.col("y") - F.lag("y").over(order)))
    lagged = both.withColumns({f"z{i}": F.lag("z", i).over(order) for i in range(1, LONG_LAGS + 1)})
    lagged = lagged.where(F.col(f"z{LONG_LAGS}").isNotNull())
    long_xs = [F.lit(1.0), *[F.col(f"z{i}") for i in range(1, LONG_LAGS + 1)]]
    long_fit = grouped_ols(lagged, by, long_xs, F.col("z")).select(*by, "beta")
    shocks = lagged.join(long_fit, by).withColumn("e", F.col("z") - _dot("beta", long_xs))
    shocks = shocks.withColumns({f"e{i}": F.lag("e", i).over(order) for i in range(1, MAX_Q + 1)})
    shocks = shocks.where(F.col(f"e{MAX_Q}").isNotNull())
    xs = [F.lit(1.0), *[F.col(f"z{i}") for i in range(1, MAX_P + 1)], *[F.col(f"e{i}") for i in range(1, MAX_Q + 1)]]
    state = F.array(
        "y", "z", *[f"z{i}" for i in range(1, MAX_P)], "e", *[f"e{i}" for i in range(1, MAX_Q)]
    )
    newest = {"_last": F.max("ds"), "_tail": F.max_by(state, "ds")}
    fits = normal_equations(shocks, by, xs, F.col("z"), newest).withColumn("_m", _best_order("sums", "n", "d"))
    fits = fits.select(*by, "_last", "_tail", "_m.p", "_m.q", "_m.beta", "_m.sigma2", "_m.aic", "_m.bic")
    fields = ["bic", "aic", "p", "d", "q", "beta", "sigma2", "_last", "_tail"]
    best = fits.groupBy(*ids).agg(F.min_by(F.struct(*fields), F.struct("bic", "aic", "d")).alias("m")).select(*ids, "m.*")
    path = best.withColumn("_path", _project("beta", "d", "sigma2", "_tail", F.lit(horizon)))
    steps = path.select("*", F.posexplode("_path").alias("_at", "_f"))
    return steps.select(
        *ids, F.date_add("_last", F.col("_at") + 1).alias("ds"), F.col("_f.yhat").alias("yhat"),
        F.col("_f.lower").alias("yhat_lower"), F.col("_f.upper").alias("yhat_upper"),
        F.format_string("(%d, %d, %d)", "p", "d", "q").alias("order"),
    )


# --- unit-root test ----------------------------------------------------------------

# Published response-surface coefficients of the test's p-value (constant, one series).
TAU_MIN, TAU_STAR, TAU_MAX = -18.83, -1.61, 2.74
TAU_SMALL_P = (2.1659, 1.4412, 0.038269)
TAU_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def unit_root_p_value(t: float) -> float:
    """Approximate p-value of a Dickey-Fuller statistic with a constant."""
    if t > TAU_MAX or t < TAU_MIN:
        return float(t > TAU_MAX)
    at = sum(c * t**i for i, c in enumerate(TAU_SMALL_P if t <= TAU_STAR else TAU_LARGE_P))
    return 0.5 * math.erfc(-at / math.sqrt(2))


@F.pandas_udf(T.IntegerType())
def _best_lag(sums: pd.Series, n: pd.Series, most: pd.Series) -> pd.Series:
    """Number of lagged differences with the lowest AIC; all fits share one product matrix."""
    out = []
    for upper, size, limit in zip(sums, n, most):
        full, cross, square = system(upper)
        scores = []
        for lags in range(limit + 1):
            k = 2 + lags
            sse = solve(full[:k, :k], cross[:k], square)[1]
            scores.append(size * np.log(max(sse / size, 1e-300)) + 2 * k)
        out.append(int(np.argmin(scores)))
    return pd.Series(out)


@F.pandas_udf(T.StructType().add("t", T.DoubleType()).add("p", T.DoubleType()))
def _level_test(sums: pd.Series, n: pd.Series, lags: pd.Series) -> pd.DataFrame:
    """t statistic of the lagged level and its p-value; NULL where the fit leaves no error."""
    rows = []
    for upper, size, used in zip(sums, n, lags):
        k = 2 + used
        full, cross, square = system(upper)
        full = full[:k, :k]
        beta, sse = solve(full, cross[:k], square)
        free = size - k
        if free < 1 or sse <= 1e-12 * square:
            rows.append((None, None))
            continue
        t = float(beta[1] / np.sqrt(sse / free * np.linalg.pinv(full)[1, 1]))
        rows.append((t, unit_root_p_value(t)))
    return pd.DataFrame(rows, columns=["t", "p"])


def unit_root_test(series: DataFrame, ids: Sequence[str], level: float = 0.05) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant per series, its lags chosen by AIC.

    Two grouped passes over the days: product sums with as many lagged
    differences as a series' length allows, from which the lag is chosen, then
    the sums of the chosen fit on all days it can use.
    """
    order = W.partitionBy(*ids).orderBy("ds")
    sized = series.withColumn("_days", F.count(F.lit(1)).over(W.partitionBy(*ids)))
    longest = sized.agg(F.max("_days")).first()[0]
    if not longest:
        raise ValueError("no series to test")
    most = math.ceil(12 * (longest / 100) ** 0.25)
    steps = sized.withColumns({"_x": F.lag("y").over(order), "_d": F.col("y") - F.lag("y").over(order)})
    steps = steps.withColumns({f"_d{i}": F.lag("_d", i).over(order) for i in range(1, most + 1)})
    allowed = F.least(F.ceil(12 * F.pow(F.col("_days") / 100, 0.25)), F.floor(F.col("_days") / 2) - 2)
    steps = materialise(steps.withColumn("_most", F.greatest(allowed, F.lit(0)).cast("int")))

    def equations(df: DataFrame, lags: Column, extra: Mapping[str, Column]) -> DataFrame:
        # Differences beyond a series' lags are 0, and rows without all of its lags are left out.
        differences = [F.when(lags >= i, F.col(f"_d{i}")).otherwise(0.0) for i in range(1, most + 1)]
        deepest = F.element_at(F.array("_d", *[f"_d{i}" for i in range(1, most + 1)]), lags + 1)
        return normal_equations(df.where(deepest.isNotNull()), ids, [F.lit(1.0), F.col("_x"), *differences], F.col("_d"), extra)

    ship_package(series.sparkSession)
    chosen = equations(steps, F.col("_most"), {"_limit": F.max("_most")}).select(
        *ids, _best_lag("sums", "n", "_limit").alias("_lags")
    )
    final = equations(steps.join(materialise(chosen), list(ids)), F.col("_lags"), {"Lags": F.max("_lags")})
    return final.withColumn("_test", _level_test("sums", "n", "Lags")).select(
        *ids, "Lags", F.col("n").alias("Observations"), F.col("_test.t").alias("Statistic"),
        F.col("_test.p").alias("PValue"), (F.col("_test.p") < level).alias("Stationary"),
    )


# --- comparison and selection --------------------------------------------------------

def forecast_with(model: str, train: DataFrame, ids: Sequence[str], horizon: int = S.HORIZON) -> DataFrame:
    """Forecasts of one model by name, tagged with it."""
    fit = {"Naive": S.naive, "SeasonalNaive": S.seasonal_naive, "ARIMA": arima,
           "LeastSquaresARIMA": least_squares_arima, "SeasonalRegression": seasonal_regression}[model]
    out = fit(train, ids, horizon)
    if "order" not in out.columns:
        out = out.withColumn("order", F.lit(None).cast("string"))
    return out.withColumn("Model", F.lit(model))


def select_models(metrics: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Mark per series the model with the smallest (sMAPE, RMSE)."""
    best = W.partitionBy(*ids).orderBy("sMAPE", "RMSE", "Model")
    return metrics.withColumn("Selected", F.row_number().over(best) == 1)


def compare_models(series: DataFrame, ids: Sequence[str], horizon: int = S.HORIZON,
                   models: Sequence[str] = MODELS) -> DataFrame:
    """Holdout metrics of every model on every series, the best one marked."""
    marked = materialise(S.split_holdout(series, ids, horizon))
    train, test = marked.where(~F.col("IsTest")), marked.where("IsTest").select(*ids, "ds", "y")
    predicted = reduce(DataFrame.unionByName, [forecast_with(m, train, ids, horizon) for m in models])
    metrics = S.forecast_metrics(predicted.join(test, [*ids, "ds"]), [*ids, "Model"])
    return select_models(metrics, ids)


def forecast_selected(series: DataFrame, comparison: DataFrame, ids: Sequence[str], horizon: int = S.HORIZON,
                      models: Sequence[str] = MODELS) -> DataFrame:
    """Refit each series' chosen model on all its days; values and bounds are not below 0."""
    chosen = comparison.where("Selected").select(*ids, "Model")
    parts = []
    for m in models:
        mine = series.join(chosen.where(F.col("Model") == m), list(ids), "left_semi")
        parts.append(forecast_with(m, mine, ids, horizon))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumns({
        c: F.when(F.col(c) < 0, F.lit(0.0)).otherwise(F.col(c)) for c in ("yhat", "yhat_lower", "yhat_upper")
    })


def selected_models(comparison: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The chosen model per series."""
    return comparison.where("Selected").select(*ids, F.col("Model").alias("SelectedModel"))


def evaluate_and_forecast(series: DataFrame, ids: Sequence[str], horizon: int = S.HORIZON) -> tuple[DataFrame, DataFrame]:
    """Comparison and final forecasts; the series and the comparison are written once and reused."""
    series = materialise(series)
    comparison = materialise(compare_models(series, ids, horizon))
    return comparison, forecast_selected(series, comparison, ids, horizon)
