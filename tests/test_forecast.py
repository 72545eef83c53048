"""Exact-likelihood ARIMA and the broken trend against brute force and planted parameters."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterstar.operators import arima, forecast, trend

START = dt.date(2024, 1, 1)
IDS = ["Metric"]


def as_series(spark, values, name="m"):
    rows = [(name, START + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "Metric string, ds date, y double")


def simulated(rng, n, phi=(0.0, 0.0), theta=(0.0, 0.0), mean=0.0, d=0, size=1.0):
    e, z = rng.normal(0, size, n + 200), np.zeros(n + 200)
    for t in range(2, n + 200):
        z[t] = phi[0] * z[t - 1] + phi[1] * z[t - 2] + e[t] + theta[0] * e[t - 1] + theta[1] * e[t - 2]
    return np.cumsum(z[200:] + mean) if d else z[200:] + mean


def dense_likelihood(y, phi, theta, mean, sigma2, skipped):
    """log density of the values after the skipped ones, given these, from the joint covariance of all."""
    n = len(y)
    move, shock = np.array([[phi[0], 1, 0], [phi[1], 0, 1], [0, 0, 0]]), np.array([1, *theta])
    reach = [np.linalg.matrix_power(move, t) for t in range(n)]
    first = np.array([m[0] for m in reach])                                       # of the state before the first day
    shocks = np.zeros((n, n))
    for t in range(1, n):
        for j in range(1, t + 1):
            shocks[t, j] = (reach[t - j] @ shock)[0]
    covariance = sigma2 * (arima.DIFFUSE * first @ first.T + shocks @ shocks.T)
    known, rest = covariance[:skipped, :skipped], covariance[skipped:, skipped:]
    side = covariance[skipped:, :skipped] @ np.linalg.inv(known)
    e = (y - mean)[skipped:] - side @ (y - mean)[:skipped]
    left = rest - side @ covariance[:skipped, skipped:]
    return -0.5 * (np.linalg.slogdet(left)[1] + e @ np.linalg.solve(left, e) + len(e) * np.log(2 * np.pi))


@pytest.mark.parametrize("phi, theta", [((0.5, 0.2), (0.4, 0.3)), ((0.0, 0.0), (-0.6, 0.0)), ((0.9, 0.0), (0.0, 0.0)), ((0.3, -0.4), (0.9, 0.2))])
def test_filter_gives_the_likelihood_of_the_joint_normal(phi, theta):
    y = simulated(np.random.default_rng(5), 40, phi, theta, 3.0)
    x = arima.free_parameters(np.array([phi]), np.array([theta]))
    np.testing.assert_allclose(np.concatenate([c[0] for c in arima.coefficients(x)]), [*phi, *theta], atol=1e-9)
    for with_mean in (True, False):
        got = arima.kalman(y[:, None], np.array([40]), np.array([4]), np.array([with_mean]), x)
        wanted = dense_likelihood(y, phi, theta, got.mean[0], got.sigma2[0], 4)
        assert got.loglik[0] == pytest.approx(wanted, abs=2e-3)
        nearby = [dense_likelihood(y, phi, theta, got.mean[0] + (0.05 * s if with_mean else 0), got.sigma2[0] * (1 + 0.05 * r), 4)
                  for s, r in ((1, 0), (-1, 0), (0, 1), (0, -1)) if with_mean or r]
        assert max(nearby) < wanted                                               # mean and variance are the best ones


def test_fit_recovers_parameters_and_never_falls_below_least_squares():
    rng = np.random.default_rng(1)
    wanted = [((0.6, 0.0), (0.0, 0.0), 0), ((0.5, 0.3), (0.0, 0.0), 0), ((0.0, 0.0), (0.7, 0.2), 0), ((0.4, 0.0), (0.5, 0.0), 1), ((0.0, 0.0), (-0.8, 0.0), 1)]
    values = [simulated(rng, 2500, phi, theta, 10.0 * (not d), d, 2.0) for phi, theta, d in wanted]
    end, x, scales, least_squares, best = arima.fit_block(values)
    assert (best <= least_squares + 1e-9).all()
    assert (best < least_squares - 0.1).sum() > 5
    phi, theta = arima.coefficients(x)
    for i, (p, t, d) in enumerate(wanted):
        lane = i * len(arima.ORDERS) + arima.ORDERS.index((sum(v != 0 for v in p), d, sum(v != 0 for v in t)))
        np.testing.assert_allclose(phi[lane], p, atol=0.07)
        np.testing.assert_allclose(theta[lane], t, atol=0.07)
        assert np.sqrt(end.sigma2[lane]) * scales[lane] == pytest.approx(2.0, rel=0.05)


def test_a_series_gives_the_same_alone_and_beside_others():
    rng = np.random.default_rng(2)
    values = [simulated(rng, n, (0.5, 0.0), (0.3, 0.0), 4.0) for n in (90, 300, 61)]
    together = arima.best_models(values, 10)
    for i, own in enumerate(values):
        alone = arima.best_models([own], 10).iloc[0]
        assert (alone["p"], alone["d"], alone["q"]) == tuple(together.loc[i, ["p", "d", "q"]])
        np.testing.assert_allclose(alone["yhat"], together.loc[i, "yhat"], rtol=1e-6)
        np.testing.assert_allclose(alone["error"], together.loc[i, "error"], rtol=1e-6)


def test_order_has_the_best_bic_of_all():
    y = simulated(np.random.default_rng(3), 400, (0.7, 0.0), (0.0, 0.0), 1.0)
    every = {o: arima.best_models([y], 1, [o]).iloc[0] for o in arima.ORDERS}
    found = arima.best_models([y], 1).iloc[0]
    assert found["bic"] == pytest.approx(min(m["bic"] for m in every.values()), abs=1e-4)
    assert (found["p"], found["d"], found["q"]) == (1, 0, 0)


def test_forecast_errors_follow_the_impulses():
    y = simulated(np.random.default_rng(4), 3000, (0.5, 0.0), (0.4, 0.0), 0.0, 1)
    found = arima.best_models([y], 20, [(1, 1, 1)]).iloc[0]
    phi, theta = found["phi"][0], found["theta"][0]
    impulse = np.array([1.0, *[(phi + theta) * phi**h for h in range(19)]])
    wanted = np.sqrt(found["sigma2"] * np.cumsum(np.cumsum(impulse) ** 2))
    np.testing.assert_allclose(found["error"], wanted, rtol=1e-3)


def test_interval_holds_its_share_of_what_follows(spark):
    rng, hits, total = np.random.default_rng(6), 0, 0
    all_ = [simulated(rng, 330, (0.6, 0.0), (0.0, 0.0), 50.0) for _ in range(24)]
    frames = [as_series(spark, y[:300], f"s{i}") for i, y in enumerate(all_)]
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.union(f)
    for r in forecast.arima(rows, IDS).collect():
        actual = all_[int(r["Metric"][1:])][(r["ds"] - START).days]
        hits, total = hits + (r["yhat_lower"] <= actual <= r["yhat_upper"]), total + 1
    assert total == 24 * 30 and 0.88 <= hits / total <= 0.99


def test_arima_of_awkward_series(spark):
    rows = as_series(spark, [5.0] * 60, "constant").union(as_series(spark, np.arange(60.0), "line")).union(as_series(spark, [0.0] * 59 + [1e9], "jump"))
    got = forecast.arima(rows, IDS).collect()
    assert len(got) == 90 and all(np.isfinite([r["yhat"], r["yhat_lower"], r["yhat_upper"]]).all() for r in got)
    assert all(r["yhat"] == pytest.approx(5.0) for r in got if r["Metric"] == "constant")
    with pytest.raises(forecast.S.ShortSeriesError):
        forecast.arima(as_series(spark, range(5)), IDS)


def test_descent_meets_the_conditions_of_the_minimum():
    rng = np.random.default_rng(8)
    x = np.maximum(np.linspace(0, 1, 200)[:, None] - np.linspace(0.05, 0.8, 12), 0)
    y = x @ np.array([0, 0, 9, 0, 0, 0, -14, 0, 0, 0, 0, 0]) + rng.normal(0, 0.3, 200)
    gram, cross, weight = x.T @ x, x.T @ y, np.full(12, 0.8)
    b = trend.penalised(gram, cross, weight, np.zeros(12))
    slope = cross - gram @ b
    assert (np.abs(slope) <= weight + 1e-6).all()
    np.testing.assert_allclose(slope[b != 0], (weight * np.sign(b))[b != 0], atol=1e-6)
    assert 0 < (b != 0).sum() < 12


def broken(rng, n, noise, breaks, start=100.0, slope=0.05):
    t = np.arange(n)
    weekly = np.array([0, 1, 2, 1, 0, -6, -8.0])[(START.weekday() + t) % 7]
    y = start + slope * t + weekly + noise * rng.normal(size=n)
    for at, change in breaks:
        y = y + change * np.maximum(t - at, 0)
    return y


def test_planted_breaks_are_found(spark):
    rng = np.random.default_rng(9)
    planted = {"up": [(320, 0.4)], "both": [(200, -0.3), (480, 0.6)], "none": []}
    rows = None
    for name, breaks in planted.items():
        own = as_series(spark, broken(rng, 800, 2.0, breaks, 300.0), name)
        rows = own if rows is None else rows.union(own)
    for r in trend.trend_models(rows, IDS).collect():
        changes = np.array(r["beta"][trend.PLAIN:])
        places = np.round((np.floor(800 * 0.8) - 1) * np.arange(1, 26) / 25)
        total = np.abs(changes).sum() / 799
        for at, change in planted[r["Metric"]]:
            near = np.abs(places - at) <= 40
            assert changes[near].sum() / 799 == pytest.approx(change, rel=0.25)
        assert total == pytest.approx(sum(abs(c) for _, c in planted[r["Metric"]]), abs=0.15)
        assert r["noise"] == pytest.approx(2.0, rel=0.15)


def test_a_broken_trend_forecasts_the_last_slope(spark):
    y = broken(np.random.default_rng(10), 730, 1.0, [(400, 0.5)], 200.0)
    got = forecast.seasonal_regression(as_series(spark, y[:700]), IDS).orderBy("ds").collect()
    np.testing.assert_allclose([r["yhat"] for r in got], y[700:], atol=6)
    straight = forecast.seasonal_regression(as_series(spark, y[:700]), IDS, breaks=0).orderBy("ds").collect()
    assert np.mean([abs(r["yhat"] - v) for r, v in zip(straight, y[700:])]) > 20
    widths = [r["yhat_upper"] - r["yhat_lower"] for r in got]
    assert np.mean(widths[-5:]) > 1.1 * np.mean(widths[:5])


def test_interval_of_the_trend_covers(spark):
    # Breaks lie where the model looks for them, and go on at the same rate after the history.
    rng, rows, all_ = np.random.default_rng(11), None, {}
    for i in range(20):
        later = 600 + np.flatnonzero(rng.random(30) < 10 / 480)
        breaks = [(at, rng.laplace(0, 0.15)) for at in [*rng.integers(0, 480, 10), *later]]
        all_[f"s{i}"] = broken(rng, 630, 3.0, breaks, 500.0)
        own = as_series(spark, all_[f"s{i}"][:600], f"s{i}")
        rows = own if rows is None else rows.union(own)
    got = forecast.seasonal_regression(rows, IDS).collect()
    inside = [r["yhat_lower"] <= all_[r["Metric"]][(r["ds"] - START).days] <= r["yhat_upper"] for r in got]
    assert len(inside) == 600 and 0.85 <= np.mean(inside) <= 1.0


def test_margins_widen_and_depend_on_nothing_but_the_fit():
    low, high = trend.margins(np.array([0.0, 50.0, -30.0]), 1.0, 300, 30)
    again = trend.margins(np.array([0.0, 50.0, -30.0]), 1.0, 300, 30)
    assert (low == again[0]).all() and (high == again[1]).all()
    assert high[-1] - low[-1] > 1.05 * (high[0] - low[0])
    flat = trend.margins(np.zeros(3), 1.0, 300, 30)
    assert np.allclose(flat[1] - flat[0], 2 * 1.96, atol=0.35)


def test_short_and_constant_series_fit(spark):
    rows = as_series(spark, [7.0] * 20, "flat").union(as_series(spark, [0.0] * 15, "zero")).union(as_series(spark, [1.0, 2.0], "two"))
    got = forecast.seasonal_regression(rows, IDS, 5).collect()
    assert len(got) == 15 and all(np.isfinite([r["yhat"], r["yhat_lower"], r["yhat_upper"]]).all() for r in got)
    assert all(r["yhat"] == pytest.approx(7.0, abs=1e-3) for r in got if r["Metric"] == "flat")
    assert all(abs(r["yhat"]) < 1e-6 for r in got if r["Metric"] == "zero")
