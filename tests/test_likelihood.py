import numpy as np
import pytest

from tallycast.functions import likelihood, stretches
from tallycast.operators import autoregression as ar
from tallycast.operators import lagsums
from tests.test_autoregression import START, series_of


def kalman(z, phi, sigma2):
    """Log-likelihood of the values by a plain Kalman filter from the stationary state."""
    p = len(phi)
    move = np.zeros((p, p))
    move[:, 0] = phi
    move[:-1, 1:] = np.eye(p - 1)
    noise = np.zeros((p, p))
    noise[0, 0] = sigma2
    spread = np.linalg.solve(np.eye(p * p) - np.kron(move, move), noise.ravel()).reshape(p, p)
    state, total = np.zeros(p), 0.0
    for value in z:
        error, size = value - state[0], spread[0, 0]
        total -= 0.5 * (np.log(2 * np.pi * size) + error * error / size)
        gain = spread[:, 0] / size
        state, spread = state + gain * error, spread - np.outer(gain, spread[0])
        state, spread = move @ state, move @ spread @ move.T + noise
    return total


def simulated(rng, phi, n):
    z = np.zeros(n + 100)
    for t in range(5, n + 100):
        z[t] = rng.normal() + sum(f * z[t - 1 - i] for i, f in enumerate(phi))
    return z[100:]


PHI = {"plain": [0.5, 0.2, -0.1, 0.1, 0.05], "slow": [1.2, -0.3, 0.05, 0, 0], "noise": [0, 0, 0, 0, 0], "swing": [-0.5, 0.2, 0, 0.1, -0.2]}


@pytest.mark.parametrize("lags", [1, 2, 5])
def test_models_are_the_best_of_the_filter(spark, lags):
    rng = np.random.default_rng(lags)
    values = {f"{name}{n}": np.cumsum(np.round(simulated(rng, phi, n) * 5) + 9) for name, phi in PHI.items() for n in (14, 60, 540)}
    models = lagsums.fit_exact(series_of(spark, values), lags=lags).collect()
    plain = {r.key: r for r in ar.fit(series_of(spark, values), lags=lags).collect()}
    assert len(models) == len(values)
    for row in models:
        z = np.diff(values[row.key].astype(int)).astype(float)
        phi = np.array(row.phi)
        own = kalman(z, phi, row.sigma2)
        assert row.n == len(z) and np.isclose(own, row.log_likelihood, rtol=1e-9)
        if row.status == "ok":
            step = 1e-4
            for move in [*np.eye(lags) * step, *-np.eye(lags) * step]:
                with np.errstate(invalid="ignore"):
                    other = kalman(z, phi + move, row.sigma2)
                roots = np.abs(np.linalg.eigvals(np.vstack([phi + move, np.eye(lags)[:-1]])))
                assert roots.max() >= 1 or other <= own + 1e-7
            assert kalman(z, phi, row.sigma2 * 1.001) < own > kalman(z, phi, row.sigma2 * 0.999)
        # The conditional fit is another one, and near on long series.
        assert plain[row.key].phi != row.phi
        if len(z) > 500 and row.status == "ok":
            assert np.allclose(plain[row.key].phi, phi, atol=0.05)
        ends = (row.last_ts, row.last_value, row.tail)
        assert ends == (plain[row.key].last_ts, plain[row.key].last_value, plain[row.key].tail)
    assert sum(r.status == "ok" for r in models) >= 9
    ahead = ar.forecast(lagsums.fit_exact(series_of(spark, values), lags=lags), 3).filter("step = 1 AND key = 'plain540'").first()
    row = next(r for r in models if r.key == "plain540")
    assert np.isclose(ahead.forecast, row.last_value + np.dot(row.phi, row.tail)) and ahead.ts > START


def test_status_of_odd_series(spark):
    values = {"line": range(0, 300, 3), "still": [4] * 30, "point": [4], "ten": [*range(0, 20, 2), 21], "eleven": [1, 3, 4, 9, 9, 9, 12, 13, 20, 22, 23, 29]}
    models = {r.key: r for r in lagsums.fit_exact(series_of(spark, values)).collect()}
    status = {k: r.status for k, r in models.items()}
    assert status.pop("eleven") in ("ok", "boundary")
    assert status == {"line": "boundary", "still": "still", "point": "insufficient", "ten": "insufficient"}
    assert models["still"].phi == [0.0] * 5 and models["still"].log_likelihood is None and models["point"].phi is None
    broken = series_of(spark, {"a": range(0, 60, 2)}).selectExpr("key", "ts", "CASE WHEN total = 8 THEN double('nan') ELSE double(total) END AS total")
    row = lagsums.fit_exact(broken).first()
    assert row.status == "failed" and row.phi is None
    assert lagsums.fit_exact(series_of(spark, {"a": [1]}).limit(0)).count() == 0


def direct(d, lags, first, total):
    products = np.array([d[h:] @ d[: len(d) - h] if h < len(d) else 0.0 for h in range(lags + 1)])
    return stretches.Stretch(len(d), products, d[:lags], d[max(len(d) - lags, 0) :], first, total, first + len(d), total + d.sum())


@pytest.mark.parametrize("seed", range(4))
def test_stretches_join_exactly(seed):
    rng = np.random.default_rng(seed)
    for _ in range(150):
        lags, parts, whole = int(rng.choice([1, 2, 5])), [], []
        for _ in range(rng.integers(1, 6)):
            d = rng.integers(-3, 9, int(rng.choice([0, 1, 2, 4, 5, 9, 20]))).astype(float)
            first, total = 7, 3.0
            if parts:
                gap, step = int(rng.choice([1, 2, 3, 5, 6, 7, 10, 11, 12, 40])), float(rng.integers(0, 9))
                first, total = parts[-1].last_minute + gap, parts[-1].last_total + step
                whole += [0.0] * (gap - 1) + [step]
            parts.append(direct(d, lags, first, total))
            whole += d.tolist()
        got, d = stretches.fold(parts), np.array(whole)
        want = direct(d, lags, 7, 3.0)
        assert (got.n, got.first_minute, got.last_minute, got.last_total) == (want.n, want.first_minute, want.last_minute, want.last_total)
        assert all(np.array_equal(a, b) for a, b in ((got.products, want.products), (got.head, want.head), (got.tail, want.tail)))
        gram, target, rows = stretches.normal_equations(got, lags)
        past = np.array([[d[t - i] for i in range(1, lags + 1)] for t in range(lags, len(d))]).reshape(-1, lags)
        assert rows == len(past) and np.array_equal(gram, past.T @ past) and np.array_equal(target, past.T @ d[lags:][: len(past)] if rows else np.zeros(lags))
        if len(d) >= 2 * lags:
            matrix = [[sum(d[i + k] * d[j + k] for k in range(len(d) - i - j)) for j in range(lags + 1)] for i in range(lags + 1)]
            assert np.array_equal(stretches.likelihood_matrix(got, lags), matrix)


def test_slopes_of_the_recursion():
    rng = np.random.default_rng(3)
    r = rng.uniform(-0.9, 0.9, (6, 5))
    phi, slope = likelihood.coefficients(r)
    for k in range(5):
        move = np.zeros(5)
        move[k] = 1e-6
        assert np.allclose((likelihood.coefficients(r + move)[0] - likelihood.coefficients(r - move)[0]) / 2e-6, slope[..., k], atol=1e-8)
    acf = np.array([[1.0, 0.5, 0.25, 0.125]])
    assert np.allclose(likelihood.partial_autocorrelations(acf), [[0.5, 0, 0]])
