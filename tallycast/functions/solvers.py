"""Small dense solves on per-key statistics, vectorised over a batch of keys.

The data-sized work (sums over rows) is done by Spark; one row per key arrives here.
"""

import sys

import numpy as np
from pyspark import cloudpickle

# Ship these functions inside the task, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def merge_moments(n, mean, co):
    """Pool groups along axis -2/-3: counts (…,g), means (…,g,k), centred co-products (…,g,k,k)."""
    total = n.sum(-1)
    safe = np.where(total > 0, total, 1.0)
    centre = (n[..., None] * mean).sum(-2) / safe[..., None]
    shift = mean - centre[..., None, :]
    spread = co + n[..., None, None] * shift[..., :, None] * shift[..., None, :]
    return total, centre, spread.sum(-3)


def _soft(x, threshold):
    return np.sign(x) * np.maximum(np.abs(x) - threshold, 0.0)


def elastic_net(n, mean, co, reg, mix):
    """Least squares of two features with an L1/L2 penalty on standardised features and label, in closed form.

    The last variable is the label. ``reg`` is the penalty strength and ``mix`` its L1 share,
    both broadcast against the leading axes. Returns coefficients (…,2) and intercept (…).
    A feature without variance, and every feature of a constant label, gets coefficient 0; of two
    features that are multiples of each other the first one counts.
    """
    count = np.where(n > 0, n, 1.0)[..., None, None]
    var = co / count
    deviation = np.sqrt(np.clip(np.diagonal(var, axis1=-2, axis2=-1), 0.0, None))
    scale = np.where(deviation > 0, deviation, 1.0)
    corr = var / (scale[..., :, None] * scale[..., None, :])
    strength = np.asarray(reg, float) / scale[..., 2]
    l1, l2 = strength * mix, strength * (1.0 - np.asarray(mix, float))
    l1, l2, g, t0, t1, d0, d1, dy = np.broadcast_arrays(
        l1, l2, corr[..., 0, 1], corr[..., 0, 2], corr[..., 1, 2], deviation[..., 0], deviation[..., 1], deviation[..., 2]
    )
    use0, use1 = (d0 > 0) & (dy > 0), (d1 > 0) & (dy > 0)
    weight = 1.0 + l2
    determinant = weight * weight - g * g

    # The optimum has both coefficients with some signs, or one of them, or none: the case whose conditions hold.
    b0, b1, done = np.zeros(l1.shape), np.zeros(l1.shape), np.zeros(l1.shape, bool)
    safe = np.where(determinant > 1e-12, determinant, 1.0)
    for s0 in (1.0, -1.0):
        for s1 in (1.0, -1.0):
            r0, r1 = t0 - l1 * s0, t1 - l1 * s1
            x0, x1 = (weight * r0 - g * r1) / safe, (weight * r1 - g * r0) / safe
            fits = use0 & use1 & (determinant > 1e-12) & ((l1 == 0) | ((x0 * s0 > 0) & (x1 * s1 > 0))) & ~done
            b0, b1, done = np.where(fits, x0, b0), np.where(fits, x1, b1), done | fits
    x0, x1 = _soft(t0, l1) / weight, _soft(t1, l1) / weight
    fits = use0 & ~done & (~use1 | (np.abs(t1 - g * x0) <= l1 + 1e-12))
    b0, done = np.where(fits, x0, b0), done | fits
    fits = use1 & ~done & (~use0 | (np.abs(t0 - g * x1) <= l1 + 1e-12))
    b1 = np.where(fits, x1, b1)

    b = np.stack([b0, b1], axis=-1)
    coef = b * scale[..., 2, None] / scale[..., :2]
    intercept = mean[..., 2] - (coef * mean[..., :2]).sum(-1)
    return coef, intercept


def mean_squared_error(n, mean, co, coef, intercept):
    """Error of a linear model on data known only by its moments (label last)."""
    p = coef.shape[-1]
    bias = mean[..., p] - (coef * mean[..., :p]).sum(-1) - intercept
    explained = (coef * co[..., :p, p]).sum(-1)
    quadratic = (coef[..., :, None] * co[..., :p, :p] * coef[..., None, :]).sum((-2, -1))
    spread = co[..., p, p] - 2.0 * explained + quadratic
    return np.clip(spread, 0.0, None) / np.where(n > 0, n, 1.0) + bias * bias


def solve_lags(gram, target, rows):
    """Autoregressive coefficients and status of many keys: systems (…,p,p), right sides (…,p), row counts.

    A rank-deficient system (a constant slope, a short series) takes the minimum-norm solution. A system
    with missing or infinite sums gives no coefficients and the status ``failed``.
    """
    size, p = target.shape
    finite = np.isfinite(gram).all((-2, -1)) & np.isfinite(target).all(-1)
    enough = finite & (rows >= 1)
    ranked = np.zeros(size, int)
    if enough.any():
        ranked[enough] = np.linalg.matrix_rank(gram[enough], hermitian=True)
    full = enough & (rows >= 2 * p) & (ranked == p)
    phi = np.full((size, p), np.nan)
    if full.any():
        phi[full] = np.linalg.solve(gram[full], target[full][..., None])[..., 0]
    for i in np.flatnonzero(enough & ~full):
        phi[i] = np.linalg.lstsq(gram[i], target[i], rcond=None)[0]
    status = np.select([~finite, rows < 1, full], ["failed", "insufficient", "ok"], "singular")
    return phi, status
