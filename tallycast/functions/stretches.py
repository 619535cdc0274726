"""Lag products of stretches of a minute series, which join exactly, and what the fits read off them.

A stretch is known by the number of its differences, the sums of products of differences h apart (h = 0..p, over the stretch), its first
and last p differences, and the minute and total at both ends. Two stretches of one series join to the stretch from the first one's start to
the second one's end: minutes between them repeat the total, so their differences are zero. One row per key or key and block arrives here.
"""

import sys
from collections.abc import Sequence
from dataclasses import dataclass, fields

import numpy as np
from pyspark import cloudpickle

# Ship these functions inside the task, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Stretch:
    n: int  # differences
    products: np.ndarray  # of differences 0..p apart
    head: np.ndarray  # the first p differences, or all
    tail: np.ndarray  # the last p differences, or all, in time order
    first_minute: int
    first_total: float
    last_minute: int
    last_total: float

    @property
    def lags(self) -> int:
        return len(self.products) - 1


def point(minute: int, total: float, lags: int) -> Stretch:
    """One minute."""
    none = np.zeros(0)
    return Stretch(0, np.zeros(lags + 1), none, none, minute, total, minute, total)


def _of_differences(d: np.ndarray, lags: int) -> np.ndarray:
    return np.array([d[h:] @ d[: len(d) - h] if h < len(d) else 0.0 for h in range(lags + 1)])


def join(a: Stretch, b: Stretch) -> Stretch:
    """The stretch over both; ``b`` begins after ``a`` ends."""
    p = a.lags
    gap = b.first_minute - a.last_minute  # differences between the two: zeros, then the step to b's first total
    step = np.zeros(min(gap, p + 1))
    step[-1] = b.first_total - a.last_total
    # Products over the border are those of the differences around it, less those that either side has within itself.
    around = [a.tail, step, b.head]
    if gap > p + 1:  # too far apart to meet: only the step meets b
        around = [step, b.head]
    border = _of_differences(np.concatenate(around), p)
    inside = (_of_differences(a.tail, p) if gap <= p + 1 else 0.0) + _of_differences(b.head, p)
    middle = np.concatenate([np.zeros(max(gap - len(step), 0) if gap <= 2 * p + 1 else p), step])
    head = np.concatenate([a.head, middle, b.head])[:p] if a.n < p else a.head
    tail = np.concatenate([a.tail, middle, b.tail])[-p:] if b.n < p else b.tail
    return Stretch(
        a.n + gap + b.n, a.products + b.products + border - inside, head, tail,
        a.first_minute, a.first_total, b.last_minute, b.last_total,
    )


def fold(parts: list[Stretch]) -> Stretch:
    whole = parts[0]
    for part in parts[1:]:
        whole = join(whole, part)
    return whole


@dataclass
class Stretches:
    """Many stretches as columns, with as many lags each; zeros fill up heads at their end and tails at their start."""

    n: np.ndarray
    products: np.ndarray
    head: np.ndarray
    tail: np.ndarray
    first_minute: np.ndarray
    first_total: np.ndarray
    last_minute: np.ndarray
    last_total: np.ndarray

    def take(self, at: np.ndarray) -> "Stretches":
        return Stretches(*(getattr(self, f.name)[at] for f in fields(self)))


Versions = tuple[np.ndarray, Stretches]  # ascending intervals, and the stretch from each of them on


def stacked(parts: Sequence[Stretches]) -> Stretches:
    return Stretches(*(np.concatenate([getattr(x, f.name) for x in parts]) for f in fields(Stretches)))


def _end(own: np.ndarray, n: np.ndarray, at: np.ndarray, step: np.ndarray, other: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """From the outside in: a side's ``n`` differences, zeros but for the step ``at`` places on, and ``behind`` places on the other side's."""
    place = np.arange(own.shape[1]) - n[:, None]
    further = place - behind[:, None]
    reached = np.take_along_axis(other, np.clip(further, 0, None), 1)
    between = np.where(place == at[:, None], step[:, None], 0.0)
    return np.where(place < 0, own, np.where(further < 0, between, reached))


def join_all(a: Stretches, b: Stretches) -> Stretches:
    """``join`` of each stretch of ``a`` with that of ``b`` in its place."""
    lags = a.head.shape[1]
    gap, step = b.first_minute - a.last_minute, b.first_total - a.last_total
    back = a.tail[:, ::-1]
    products = a.products + b.products
    products[:, 0] += step * step
    for h in range(1, lags + 1):
        products[:, h] += step * b.head[:, h - 1]
        for near in range(1, h + 1):
            across = step * back[:, h - near]
            for k in range(h - near):
                across += back[:, k] * b.head[:, h - 1 - near - k]
            products[:, h] += np.where(gap == near, across, 0.0)
    return Stretches(
        a.n + gap + b.n, products, _end(a.head, a.n, gap - 1, step, b.head, gap),
        _end(b.tail[:, ::-1], b.n, np.zeros_like(gap), step, back, gap)[:, ::-1],
        a.first_minute, a.first_total, b.last_minute, b.last_total,
    )


def _joined(a: Versions, b: Versions) -> Versions:
    """The versions of the stretch over both: one wherever either side has one."""
    at = np.union1d(a[0], b[0])
    i, j = np.searchsorted(a[0], at, "right") - 1, np.searchsorted(b[0], at, "right") - 1
    both = (i >= 0) & (j >= 0)
    parts = [a[1].take(i[j < 0]), b[1].take(j[i < 0]), join_all(a[1].take(i[both]), b[1].take(j[both]))]
    order = np.argsort(np.concatenate([at[j < 0], at[i < 0], at[both]]))
    return at, stacked(parts).take(order)


def fold_versions(parts: list[Versions]) -> Versions:
    """``fold`` at every interval; a version costs as many joins as the parts can be halved."""
    while len(parts) > 1:
        parts = [_joined(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def versions_of(interval: np.ndarray, minute: np.ndarray, total: np.ndarray, lags: int) -> Versions:
    """A series' versions from its minutes' totals, which hold from their interval on; rows by interval."""
    start = int(minute.min())
    at = minute - start
    known, held = np.zeros(int(at.max()) + 1, bool), np.zeros(int(at.max()) + 1)
    begin = np.flatnonzero(np.diff(interval, prepend=interval[0] - 1))
    size = len(begin)
    products, head, tail = np.zeros((size, lags + 1)), np.zeros((size, lags)), np.zeros((size, lags))
    ends, totals = np.zeros((size, 2), np.int64), np.zeros((size, 2))
    for i, (lo, hi) in enumerate(zip(begin, [*begin[1:], len(at)])):
        known[at[lo:hi]], held[at[lo:hi]] = True, total[lo:hi]
        points = np.flatnonzero(known)
        values = held[points]
        d = np.zeros(points[-1] - points[0])
        d[points[1:] - points[0] - 1] = np.diff(values)
        products[i] = _of_differences(d, lags)
        few = min(len(d), lags)
        head[i, :few], tail[i, lags - few :] = d[:few], d[len(d) - few :]
        ends[i], totals[i] = points[[0, -1]], values[[0, -1]]
    first, last = ends[:, 0] + start, ends[:, 1] + start
    return interval[begin], Stretches(last - first, products, head, tail, first, totals[:, 0], last, totals[:, 1])


def _cut(x: Stretch, h: int, first: int, last: int) -> float:
    """The sum of products h apart without the ``first`` earliest and ``last`` latest of them."""
    head, tail = x.head, x.tail
    before = sum(head[k] * head[k + h] for k in range(first))
    after = sum(tail[-1 - k] * tail[-1 - k - h] for k in range(last))
    return float(x.products[h] - before - after)


def _all(x: Stretch) -> np.ndarray | None:
    """Every difference, where the two ends hold them all."""
    p = x.lags
    return np.concatenate([x.head, x.tail[len(x.tail) - (x.n - len(x.head)) :]]) if x.n <= 2 * p else None


def normal_equations(x: Stretch, lags: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Conditional least squares: the lags' products, their products with the target, and the rows that have all lags."""
    rows = max(x.n - lags, 0)
    gram, target = np.zeros((lags, lags)), np.zeros(lags)
    if not rows:
        return gram, target, 0
    d = _all(x)
    for i in range(1, lags + 1):
        if d is not None:
            target[i - 1] = d[lags:] @ d[lags - i : x.n - i]
        else:
            target[i - 1] = _cut(x, i, lags - i, 0)
        for j in range(i, lags + 1):
            if d is not None:
                value = d[lags - i : x.n - i] @ d[lags - j : x.n - j]
            else:
                value = _cut(x, j - i, lags - j, i)
            gram[i - 1, j - 1] = gram[j - 1, i - 1] = value
    return gram, target, rows


def likelihood_matrix(x: Stretch, lags: int) -> np.ndarray:
    """The matrix whose quadratic form in (1, -phi) is the exact sum of squares; needs at least twice as many differences as lags."""
    out = np.zeros((lags + 1, lags + 1))
    d = _all(x)
    for i in range(lags + 1):
        for j in range(i, lags + 1):
            out[i, j] = out[j, i] = d[i : x.n - j] @ d[j : x.n - i] if d is not None else _cut(x, j - i, i, i)
    return out
