"""Elastic net by coordinate descent on moments, for many keys and grid points at once."""

import sys

import numpy as np
from pyspark import cloudpickle

# Ship these functions inside the task, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SWEEPS = 20_000
GAP = 1e-10


def _soft(x, threshold):
    return np.sign(x) * np.maximum(np.abs(x) - threshold, 0.0)


def optimality_gap(corr, target, l1, l2, b):
    """How far the optimality conditions are missed, at most: 0 at the minimum. Of correlations, where 1 is large."""
    pull = target - (corr @ b[..., None])[..., 0] - l2[..., None] * b
    kept = np.abs(pull - l1[..., None] * np.sign(b))
    left_out = np.maximum(np.abs(pull) - l1[..., None], 0.0)
    return np.where(b != 0, kept, left_out).max(-1, initial=0.0)


def elastic_net(n, mean, co, reg, mix, sweeps=SWEEPS, gap=GAP):
    """Least squares with an L1/L2 penalty on standardised features and label; the last variable is the label.

    ``reg`` is the penalty's strength and ``mix`` its L1 share, both broadcast against the leading axes. Returns coefficients (…,d), the
    intercept (…), and the gap to optimality (…). A feature without variance, and every feature of a constant label, gets 0. Features that
    depend on each other share a solution that the descent reaches from zero.
    """
    d = co.shape[-1] - 1
    var = co / np.where(n > 0, n, 1.0)[..., None, None]
    deviation = np.sqrt(np.clip(np.diagonal(var, axis1=-2, axis2=-1), 0.0, None))
    scale = np.where(deviation > 0, deviation, 1.0)
    corr = var / (scale[..., :, None] * scale[..., None, :])
    strength = np.asarray(reg, float) / scale[..., d]
    l1, l2 = np.broadcast_arrays(strength * mix, strength * (1.0 - np.asarray(mix, float)))
    use = (deviation[..., :d] > 0) & (deviation[..., d:] > 0)
    shape = (*l1.shape, d)
    r = np.broadcast_to(corr[..., :d, :d], (*shape, d)).reshape(-1, d, d)
    t = np.broadcast_to(corr[..., :d, d], shape).reshape(-1, d)
    use = np.broadcast_to(use, shape).reshape(-1, d)
    f1, f2 = l1.reshape(-1), l2.reshape(-1)
    t, r = np.where(use, t, 0.0), np.where(use[:, :, None] & use[:, None, :], r, 0.0)
    b, missed = np.zeros(t.shape), np.zeros(len(t))
    going = np.arange(len(t))
    # Without a penalty on well-conditioned features the minimum is a linear solve, which long descents only creep up on.
    plain = np.flatnonzero(f1 == 0)
    if len(plain):
        system = r[plain] + (f2[plain, None, None] + ~use[plain][:, :, None]) * np.eye(d)
        solvable = np.linalg.cond(system) < 1e10
        at = plain[solvable]
        if len(at):
            b[at] = np.linalg.solve(system[solvable], t[at][..., None])[..., 0]
    for _ in range(max(sweeps // 10, 1)):
        missed[going] = optimality_gap(r[going], t[going], f1[going], f2[going], b[going])
        going = going[missed[going] > gap]
        if not len(going):
            break
        rg, tg, bg, ag, cg = r[going], t[going], b[going], f1[going], f2[going]
        for _ in range(10):
            for j in range(d):
                rest = tg[:, j] - (rg[:, j] * bg).sum(-1) + rg[:, j, j] * bg[:, j]
                bg[:, j] = _soft(rest, ag) / (1.0 + cg)
        b[going] = bg
    missed = optimality_gap(r, t, f1, f2, b).reshape(l1.shape)
    b = b.reshape(shape)
    coef = b * scale[..., d, None] / scale[..., :d]
    return coef, mean[..., d] - (coef * mean[..., :d]).sum(-1), missed
