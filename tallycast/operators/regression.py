"""Linear regression of the cumulative count on hour and minute, for all keys at once.

Every fit works from moments (counts, means, centred co-products) that Spark aggregates per
key, or per key and fold, in one pass; the solve then sees one row per key.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.functions.solvers import elastic_net, mean_squared_error, merge_moments

FEATURES = ("hour", "minute")
LABEL = "cumulative_votes"
FOLDS = 5

# The tuning grid, strength outer and L1 share inner.
GRID_STRENGTH = (0.01, 0.1, 0.5, 1.0)
GRID_L1_SHARE = (0.0, 0.5, 1.0)

MIN_ROWS = 3  # fewer rows than coefficients cannot be fitted


def _moments(label: str) -> list[Column]:
    """Count, means and population covariances of (hour, minute, label), partially aggregated."""
    names = [*FEATURES, label]
    columns = [F.col(c).cast("double") for c in names]
    tags = ["h", "m", "y"]
    out = [F.count(F.col(label)).alias("n")]
    out += [F.avg(c).alias(f"mean_{t}") for c, t in zip(columns, tags)]
    for i, t in enumerate(tags):
        for j in range(i, 3):
            out.append(F.covar_pop(columns[i], columns[j]).alias(f"cov_{t}{tags[j]}"))
    return out


def fit_ols(slots: DataFrame, key: str = "key", label: str = LABEL) -> DataFrame:
    """Unpenalised fit per key: ``(key, hour_coef, minute_coef, intercept, n, status)``.

    A feature without variance gets coefficient 0. Keys with too few rows keep a row with null
    coefficients, so one bad key never hides or stops the others.
    """
    m = slots.groupBy(key).agg(*_moments(label))
    vh, vm, chm = F.col("cov_hh"), F.col("cov_mm"), F.col("cov_hm")
    chy, cmy = F.col("cov_hy"), F.col("cov_my")
    det = vh * vm - chm * chm
    independent = det > vh * vm * 1e-12
    hour = (
        F.when(independent, (chy * vm - cmy * chm) / det)
        .when(vh > 0, chy / vh)
        .otherwise(0.0)
    )
    minute = (
        F.when(independent, (cmy * vh - chy * chm) / det)
        .when((vh == 0) & (vm > 0), cmy / vm)
        .otherwise(0.0)
    )
    enough = F.col("n") >= MIN_ROWS
    fitted = m.withColumns({"hour_coef": F.when(enough, hour), "minute_coef": F.when(enough, minute)})
    intercept = (
        F.col("mean_y") - F.col("hour_coef") * F.col("mean_h") - F.col("minute_coef") * F.col("mean_m")
    )
    status = F.when(~enough, "insufficient").when(independent, "ok").otherwise("singular")
    return fitted.select(key, "hour_coef", "minute_coef", intercept.alias("intercept"), "n", status.alias("status"))


def hashed_fold(key: str = "key", folds: int = FOLDS) -> Column:
    """Repeatable pseudo-random fold of a slot."""
    return F.pmod(F.xxhash64(F.col(key), *[F.col(f) for f in FEATURES]), F.lit(folds)).cast("int")


def _grid() -> tuple[np.ndarray, np.ndarray]:
    strength = np.repeat(GRID_STRENGTH, len(GRID_L1_SHARE))
    share = np.tile(GRID_L1_SHARE, len(GRID_STRENGTH))
    return strength, share


_MOMENT_COLUMNS = (
    "n", "mean_h", "mean_m", "mean_y", "cov_hh", "cov_hm", "cov_hy", "cov_mm", "cov_my", "cov_yy",
)


def _grid_search(folds: int, key: str, strength: np.ndarray, share: np.ndarray):
    """Batch function: the folds' moments of each key in, one row per key and grid point out."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = len(batch)
            if size == 0:
                continue
            raw = np.zeros((size, folds, 10))
            for row, (which, *stats) in enumerate(zip(batch["fold"], *[batch[c] for c in _MOMENT_COLUMNS])):
                raw[row, np.asarray(which, int)] = np.stack([np.asarray(s, float) for s in stats], axis=1)
            n, mean, packed = raw[..., 0], raw[..., 1:4], raw[..., 4:]
            co = packed[..., [0, 1, 2, 1, 3, 4, 2, 4, 5]].reshape(size, folds, 3, 3) * n[..., None, None]

            rmse = np.full((size, folds, len(strength)), np.nan)
            for held in range(folds):
                rest = [f for f in range(folds) if f != held]
                train = merge_moments(n[:, rest], mean[:, rest], co[:, rest])
                coef, intercept = elastic_net(
                    train[0][:, None], train[1][:, None], train[2][:, None], strength, share
                )
                error = mean_squared_error(
                    n[:, held, None], mean[:, held, None], co[:, held, None], coef, intercept
                )
                usable = (train[0] > 0) & (n[:, held] > 0)
                rmse[usable, held] = np.sqrt(error[usable])
            used = (~np.isnan(rmse)).sum(1)
            score = np.where(used > 0, np.nansum(rmse, axis=1) / np.maximum(used, 1), np.nan)

            whole = merge_moments(n, mean, co)
            coef, intercept = elastic_net(whole[0][:, None], whole[1][:, None], whole[2][:, None], strength, share)
            points = len(strength)
            yield pd.DataFrame({
                key: np.repeat(batch[key].to_numpy(), points),
                "grid": np.tile(np.arange(points), size),
                "reg_param": np.tile(strength, size),
                "elastic_net_param": np.tile(share, size),
                "mean_rmse": score.ravel(),
                "hour_coef": coef[..., 0].ravel(),
                "minute_coef": coef[..., 1].ravel(),
                "intercept": intercept.ravel(),
                "n": np.repeat(whole[0].astype("int64"), points),
            })

    return search


def cv_grid(
    slots: DataFrame, key: str = "key", label: str = LABEL, fold: Column | None = None, folds: int = FOLDS
) -> DataFrame:
    """Cross-validated error of each grid point, and its fit on all rows, per key.

    The score is the mean of the per-fold errors (RMSE). Keys with too few rows are left to
    ``fit_best``, which reports them.
    """
    which = hashed_fold(key, folds) if fold is None else fold.cast("int")
    per_fold = slots.withColumn("fold", which).groupBy(key, "fold").agg(*_moments(label))
    stat = F.struct("fold", *_MOMENT_COLUMNS)
    per_key = (
        per_fold.groupBy(key)
        .agg(F.collect_list(stat).alias("stat"), F.sum("n").alias("rows"))  # one entry per fold
        .filter(F.col("rows") >= MIN_ROWS)
        .select(key, *[F.col("stat")[c].alias(c) for c in ("fold", *_MOMENT_COLUMNS)])
    )
    key_type = slots.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {key_type}, grid int, reg_param double, elastic_net_param double, mean_rmse double, "
        "hour_coef double, minute_coef double, intercept double, n bigint"
    )
    return per_key.mapInPandas(_grid_search(folds, key, *_grid()), schema)


def fit_best(
    slots: DataFrame, key: str = "key", label: str = LABEL, fold: Column | None = None, folds: int = FOLDS
) -> DataFrame:
    """Per key, the grid point with the smallest mean error, ties to the first in grid order.

    Keys with too few rows keep a row with null coefficients and status ``insufficient``.
    """
    grid = cv_grid(slots, key, label, fold, folds)
    chosen = F.struct("reg_param", "elastic_net_param", "mean_rmse", "hour_coef", "minute_coef", "intercept")
    best = grid.groupBy(key).agg(F.min_by(chosen, F.struct("mean_rmse", "grid")).alias("best"))
    rows = slots.groupBy(key).agg(F.count(label).alias("n"))
    together = rows.unionByName(best, allowMissingColumns=True).groupBy(key).agg(
        F.max("n").alias("n"), F.max("best").alias("best")
    )
    status = F.when(F.col("best").isNull(), "insufficient").otherwise("ok").alias("status")
    return together.select(key, "best.*", "n", status)


def predict() -> Column:
    """Prediction of a row that carries a model's coefficients next to hour and minute."""
    return F.col("hour_coef") * F.col("hour") + F.col("minute_coef") * F.col("minute") + F.col("intercept")


def score_slots(models: DataFrame, slots: DataFrame, key: str = "key") -> DataFrame:
    """Every model on every time-of-day slot, as ``(key, hour, minute, scaled_votes)``.

    ``slots`` has one row per (hour, minute), so never more than 1 440: they are listed once and
    spread over the models, which stay distributed.
    """
    listed = slots.agg(F.collect_set(F.struct("hour", "minute")).alias("slots"))
    fitted = models.filter(F.col("intercept").isNotNull())
    spread = fitted.select(
        key, "hour_coef", "minute_coef", "intercept", F.explode(listed.scalar()).alias("_slot")
    ).select("*", "_slot.*")
    return spread.select(key, "hour", "minute", predict().alias("scaled_votes"))


def evaluate(models: DataFrame, slots: DataFrame, key: str = "key", label: str = LABEL, scope: str = "own_key") -> DataFrame:
    """RMSE per model, on its own key's rows or (``scope="all_keys"``) on the rows of every key.

    Over all keys the error follows from the pooled moments of the rows, one small record, so
    models and rows are never paired.
    """
    if scope == "own_key":
        joined = slots.join(models.select(key, "hour_coef", "minute_coef", "intercept"), key)
        error = F.col(label) - predict()
        return joined.groupBy(key).agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    pooled = slots.agg(F.struct(*_moments(label)).alias("m"))
    fitted = models.filter(F.col("intercept").isNotNull()).withColumn("_m", pooled.scalar())
    m, b, c = F.col("_m"), F.col("hour_coef"), F.col("minute_coef")
    bias = m["mean_y"] - b * m["mean_h"] - c * m["mean_m"] - F.col("intercept")
    spread = (
        m["cov_yy"] - 2 * (b * m["cov_hy"] + c * m["cov_my"])
        + b * b * m["cov_hh"] + 2 * b * c * m["cov_hm"] + c * c * m["cov_mm"]
    )
    return fitted.select(key, F.sqrt(F.greatest(spread, F.lit(0.0)) + bias * bias).alias("rmse"))
