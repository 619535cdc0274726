"""Exact Gaussian likelihood of stationary autoregressions, for many keys at once.

With the matrix D of lag products corrected at both ends, the exact sum of squares of n values is S = a'Da for a = (1, -phi). The
determinant of the values' first p covariances is a product of powers of one less the squared partial autocorrelations r_k, so that

    log-likelihood = -n/2 (log(2 pi S/n) + 1) + 1/2 sum_k k log(1 - r_k^2)

at the best variance S/n. The fit is Newton's method over u with r = tanh u, which keeps every step stationary.
"""

import sys

import numpy as np
from pyspark import cloudpickle

# Ship these functions inside the task, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EDGE = 8.0  # largest |u|: a partial autocorrelation within 2.3e-7 of one
STEPS = 200


def coefficients(r):
    """Coefficients (…,p) and their derivatives (…,p,p) by the partial autocorrelations (…,p), by Levinson's recursion."""
    p = r.shape[-1]
    phi = np.zeros(r.shape)
    slope = np.zeros((*r.shape, p))  # [..., j, m]: of coefficient j by r_m
    for k in range(p):
        rk = r[..., k : k + 1]
        back, back_slope = phi[..., :k][..., ::-1], slope[..., :k, :][..., ::-1, :]
        grown = phi[..., :k] - rk * back
        grown_slope = slope[..., :k, :] - rk[..., None] * back_slope
        grown_slope[..., :, k] -= back
        phi = np.concatenate([grown, rk, phi[..., k + 1 :]], axis=-1)
        slope = np.concatenate([grown_slope, slope[..., k:, :]], axis=-2)
        slope[..., k, :] = 0.0
        slope[..., k, k] = 1.0
    return phi, slope


def partial_autocorrelations(acf):
    """Of autocovariances (…,p+1) with the lag-0 one first, by Durbin's recursion; all below one in size."""
    p = acf.shape[-1] - 1
    r = np.zeros((*acf.shape[:-1], p))
    phi = np.zeros((*acf.shape[:-1], 0))
    error = np.where(acf[..., 0] > 0, acf[..., 0], 1.0)
    for k in range(p):
        r[..., k] = (acf[..., k + 1] - (phi * acf[..., 1 : k + 1][..., ::-1]).sum(-1)) / error
        r[..., k] = np.clip(r[..., k], -0.999, 0.999)
        phi = np.concatenate([phi - r[..., k : k + 1] * phi[..., ::-1], r[..., k : k + 1]], axis=-1)
        error = error * (1.0 - r[..., k] ** 2)
    return r


def squares(d, phi):
    a = np.concatenate([np.ones((*phi.shape[:-1], 1)), -phi], axis=-1)
    da = (d @ a[..., None])[..., 0]
    return (a * da).sum(-1), da


def log_likelihood(d, n, u):
    """At the best variance, per key."""
    r = np.tanh(u)
    s, _ = squares(d, coefficients(r)[0])
    order = np.arange(1, u.shape[-1] + 1)
    return -0.5 * n * (np.log(2.0 * np.pi * np.maximum(s, 1e-300) / n) + 1.0) + 0.5 * (order * np.log1p(-r * r)).sum(-1)


def _downhill(d, n, u):
    """Gradient of minus the log-likelihood by u."""
    r = np.tanh(u)
    phi, slope = coefficients(r)
    s, da = squares(d, phi)
    by_phi = -(n / np.maximum(s, 1e-300))[..., None] * da[..., 1:]
    return (by_phi[..., None, :] @ slope)[..., 0, :] * (1.0 - r * r) + np.arange(1, u.shape[-1] + 1) * r


def fit(d, n):
    """Coefficients, variance, log-likelihood and whether the search settled, of matrices (keys,p+1,p+1) and counts (keys,).

    A key settles where the slope is nothing for its size. One whose likelihood still grows at the border of the stationary region (a
    constant slope, for one) stays at EDGE and doesn't.
    """
    n = np.asarray(n, float)
    p = d.shape[-1] - 1
    # Start from the moments: the first row without the end correction is an autocovariance, which is always stationary.
    u = np.arctanh(partial_autocorrelations(d[..., 0, :]))
    going = np.ones(len(n), bool)
    settled = np.zeros(len(n), bool)
    small = 1e-5
    for _ in range(STEPS):
        at = np.flatnonzero(going)
        if not len(at):
            break
        da, na, ua = d[at], n[at], u[at]
        gradient = _downhill(da, na, ua)
        curve = np.empty((len(at), p, p))
        for k in range(p):
            move = np.zeros(p)
            move[k] = small
            curve[:, :, k] = (_downhill(da, na, ua + move) - _downhill(da, na, ua - move)) / (2.0 * small)
        curve = (curve + curve.transpose(0, 2, 1)) / 2.0
        values, vectors = np.linalg.eigh(curve)
        # Uphill or flat directions are walked downhill at the size of their slope.
        values = np.maximum(np.abs(values), 1e-8 * np.maximum(np.abs(values).max(-1, keepdims=True), 1e-8))
        step = -(vectors @ ((vectors.transpose(0, 2, 1) @ gradient[..., None]) / values[..., None]))[..., 0]
        step *= np.minimum(1.0, 2.0 / np.maximum(np.abs(step).max(-1, keepdims=True), 1e-300))
        here = log_likelihood(da, na, ua)
        scale, best = np.ones(len(at)), ua.copy()
        waiting = np.ones(len(at), bool)
        for _ in range(40):
            tried = np.clip(ua + scale[:, None] * step, -EDGE, EDGE)
            better = waiting & (log_likelihood(da, na, tried) > here)
            best[better] = tried[better]
            waiting &= ~better
            if not waiting.any():
                break
            scale[waiting] /= 2.0
        u[at] = best
        flat = np.abs(gradient).max(-1) <= 1e-9 * na
        done = flat | waiting  # no step is better: at the best, to rounding
        near = np.abs(gradient).max(-1) <= 1e-5 * na
        settled[at] = done & near & (np.abs(best).max(-1) < EDGE)
        going[at] = ~done
    phi = coefficients(np.tanh(u))[0]
    return phi, squares(d, phi)[0] / n, log_likelihood(d, n, u), settled
