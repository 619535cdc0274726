"""Elastic-net regression on any number of features, for all keys at once, tuned by cross-validation.

Tasks sum up counts, means and centred products of an array of features and the label per key and fold, a row each; these rows are merged per
key, where the descent runs. No row of the data is shuffled.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.functions.descent import GAP, elastic_net
from tallycast.functions.solvers import mean_squared_error, merge_moments
from tallycast.operators.regression import FOLDS, GRID_L1_SHARE, GRID_STRENGTH

GROUPS = 4096  # keys and folds that a task sums up before it hands them on


def _task_moments(size: int):
    """Batch function: rows of key, fold and a vector (features, then the label) to the moments of each key and fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[float, np.ndarray, np.ndarray]] = {}

        def hand_on(kind: pa.DataType) -> pa.RecordBatch:
            rows = list(held.items())
            held.clear()
            flat = lambda i: pa.array([np.ravel(x[i]).tolist() for _, x in rows], pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays(
                [pa.array([k for (k, _), _ in rows], kind), pa.array([f for (_, f), _ in rows], pa.int32()),
                 pa.array([x[0] for _, x in rows], pa.float64()), flat(1), flat(2)],
                names=["key", "fold", "n", "mean", "co"],
            )

        kind = None
        for batch in batches:
            kind = batch.column("key").type
            if not batch.num_rows:
                continue
            values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            whole = np.isfinite(values).all(1)
            coded = batch.column("key").dictionary_encode()
            numbers = coded.indices.fill_null(-1).to_numpy().astype(np.int64)
            group = numbers * 1000 + batch.column("fold").to_numpy()
            names = coded.dictionary.to_pylist()
            for code in np.unique(group[whole]).tolist():
                x = values[whole & (group == code)]
                number, fold = divmod(code, 1000)
                mean = x.mean(0)
                own = (float(len(x)), mean, (x - mean).T @ (x - mean))
                name = (None if number < 0 else names[number], fold)
                if name in held:
                    pair = [np.stack([a, b])[None] for a, b in zip(held[name], own)]
                    total, centre, co = merge_moments(*pair)
                    own = (float(total[0]), centre[0], co[0])
                held[name] = own
            if len(held) > GROUPS:
                yield hand_on(kind)
        if held:
            yield hand_on(kind)

    return run


def fold_moments(rows: DataFrame, features: Sequence[str], label: str, key: str, fold: Column) -> DataFrame:
    """``(key, fold, n, mean, co)`` per task; rows with a missing or infinite value are left out."""
    vector = F.array(*[F.col(c).cast("double") for c in (*features, label)])
    kind = rows.schema[key].dataType.simpleString()
    chosen = rows.select(F.col(key).alias("key"), fold.cast("int").alias("fold"), vector.alias("vector"))
    chosen = chosen.filter(~F.exists("vector", lambda x: x.isNull()) & F.col("fold").isNotNull())
    return chosen.mapInArrow(_task_moments(len(features) + 1), f"key {kind}, fold int, n double, mean array<double>, co array<double>")


def hashed_fold(key: str, features: Sequence[str], folds: int = FOLDS) -> Column:
    """Repeatable pseudo-random fold of a row."""
    return F.pmod(F.xxhash64(key, *features), F.lit(folds)).cast("int")


def fit_features(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    key: str = "key",
    fold: Column | None = None,
    folds: int = FOLDS,
    strengths: Sequence[float] = GRID_STRENGTH,
    shares: Sequence[float] = GRID_L1_SHARE,
) -> DataFrame:
    """Per key the grid point of the smallest mean held-out RMSE (ties to the first), fitted on all rows.

    ``(key, coefficients, intercept, reg_param, elastic_net_param, mean_rmse, n, gap, status)``; coefficients are in the order of ``features``.
    ``gap`` tells how far the optimality conditions are missed, status ``unsettled`` that it is more than it should be; ``insufficient``
    keys have no more rows than features and null results.
    """
    size, points = len(features) + 1, len(strengths) * len(shares)
    strength, share = np.repeat(strengths, len(shares)).astype(float), np.tile(shares, len(strengths)).astype(float)
    which = hashed_fold(key, features, folds) if fold is None else fold
    parts = fold_moments(rows, features, label, key, which)
    # A row per task and fold, whatever the key holds.
    per_key = parts.groupBy("key").agg(F.collect_list(F.struct("fold", "n", "mean", "co")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("coefficients", "intercept", "reg", "share", "rmse", "n", "gap", "status")}
            for found in batch.column("parts").to_pylist():
                n, mean, co = np.zeros(folds), np.zeros((folds, size)), np.zeros((folds, size, size))
                for f in range(folds):
                    own = [x for x in found if x["fold"] == f]
                    if own:
                        stacked = (
                            np.array([x["n"] for x in own]), np.array([x["mean"] for x in own]),
                            np.array([x["co"] for x in own]).reshape(-1, size, size),
                        )
                        n[f], mean[f], co[f] = merge_moments(*stacked)
                whole = merge_moments(n, mean, co)
                if whole[0] < size:
                    for name, value in zip(out, (None, None, None, None, None, int(whole[0]), None, "insufficient")):
                        out[name].append(value)
                    continue
                rmse = np.full((folds, points), np.nan)
                for held in range(folds):
                    rest = [f for f in range(folds) if f != held]
                    train = merge_moments(n[rest], mean[rest], co[rest])
                    if train[0] > 0 and n[held] > 0:
                        coef, intercept, _ = elastic_net(train[0], train[1], train[2], strength, share)
                        rmse[held] = np.sqrt(mean_squared_error(n[held], mean[held], co[held], coef, intercept))
                used = ~np.isnan(rmse[:, 0])
                score = rmse[used].mean(0) if used.any() else np.full(points, np.nan)
                best = int(np.nanargmin(score)) if used.any() else 0
                coef, intercept, gap = elastic_net(*whole, strength[best], share[best])
                values = (
                    coef.tolist(), float(intercept), strength[best], share[best], float(score[best]) if used.any() else None, int(whole[0]),
                    float(gap), "ok" if gap <= GAP else "unsettled",
                )
                for name, value in zip(out, values):
                    out[name].append(value)
            kinds = [pa.list_(pa.float64()), *[pa.float64()] * 4, pa.int64(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(x, t) for x, t in zip(out.values(), kinds))],
                names=["key", "coefficients", "intercept", "reg_param", "elastic_net_param", "mean_rmse", "n", "gap", "status"],
            )

    kind = rows.schema[key].dataType.simpleString()
    models = per_key.mapInArrow(
        run,
        f"key {kind}, coefficients array<double>, intercept double, reg_param double, elastic_net_param double, mean_rmse double, "
        "n bigint, gap double, status string",
    )
    return models.withColumnRenamed("key", key)


def predict(features: Sequence[str]) -> Column:
    """Prediction of a row that carries a model's coefficients and intercept next to its features."""
    products = [F.col("coefficients")[i] * F.col(c).cast("double") for i, c in enumerate(features)]
    total = F.col("intercept")
    for product in products:
        total = total + product
    return total
