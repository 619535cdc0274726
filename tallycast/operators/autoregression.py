"""Autoregression of order p on the first differences of a series, for all keys at once.

Conditional least squares without a constant: Spark sums the lag products per key, a p by p
system is solved per key, and the recursion runs on one row per key.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.functions.solvers import solve_lags

LAGS = 5
LIVE_HORIZON = 45  # fixed values: forecast steps of the live and the batch path
BATCH_HORIZON = 10


def lag_features(
    series: DataFrame, by: Sequence[str] = ("key",), ts: str = "ts", value: str = "total", lags: int = LAGS
) -> DataFrame:
    """First difference ``d`` with its predecessors ``l1`` to ``lp``; rows of a series' start have null lags."""
    in_order = W.partitionBy(*by).orderBy(ts)
    differences = series.withColumn("d", F.col(value) - F.lag(value).over(in_order))
    return differences.withColumns({f"l{i}": F.lag("d", i).over(in_order) for i in range(1, lags + 1)})


def lag_products(target: Column, past: Sequence[Column]) -> dict[str, Column]:
    """Row count ``n`` and lag products ``g_i_j``, ``r_i`` that a difference adds to the normal equations.

    Zero while the oldest lag is missing. Sums run in double: exact for integers below 2**53, and
    never overflowing beyond.
    """
    complete = past[-1].isNotNull()
    past = [p.cast("double") for p in past]
    lags = range(1, len(past) + 1)
    products = {f"g_{i}_{j}": past[i - 1] * past[j - 1] for i in lags for j in lags if j >= i}
    products |= {f"r_{i}": past[i - 1] * target.cast("double") for i in lags}
    terms = {name: F.when(complete, product).otherwise(0.0) for name, product in products.items()}
    return {"n": complete.cast("bigint")} | terms


def _past(lags: int) -> list[Column]:
    return [F.col(f"l{i}") for i in range(1, lags + 1)]


def recent(lags: int) -> Column:
    """The newest difference and those before it, where the forecast recursion starts."""
    return F.array(F.col("d"), *_past(lags)[:-1]).cast("array<double>")


def normal_equations(
    series: DataFrame, by: Sequence[str] = ("key",), ts: str = "ts", value: str = "total", lags: int = LAGS
) -> DataFrame:
    """Per series: rows with all lags, summed lag products, and the series' end."""
    features = lag_features(series, by, ts, value, lags)
    last = F.struct(
        F.col(ts).alias("last_ts"), F.col(value).cast("double").alias("last_value"), recent(lags).alias("tail")
    )
    sums = [F.sum(term).alias(name) for name, term in lag_products(F.col("d"), _past(lags)).items()]
    grouped = features.groupBy(*by).agg(*sums, F.max_by(last, F.col(ts)).alias("_last"))
    return grouped.select("*", "_last.*").drop("_last")


def _solve(lags: int, by: Sequence[str]):
    def solve_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = len(batch)
            gram, target = np.zeros((size, lags, lags)), np.zeros((size, lags))
            for i in range(1, lags + 1):
                target[:, i - 1] = batch[f"r_{i}"]
                for j in range(i, lags + 1):
                    gram[:, i - 1, j - 1] = gram[:, j - 1, i - 1] = batch[f"g_{i}_{j}"]
            phi, status = solve_lags(gram, target, batch["n"].to_numpy())
            out = batch[[*by, "n", "last_ts", "last_value", "tail"]].copy()
            known = np.isin(status, ("ok", "singular"))
            out["phi"] = pd.Series([x.tolist() if k else None for x, k in zip(phi, known)], index=out.index, dtype=object)
            out["status"] = status
            yield out

    return solve_batches


def solve(equations: DataFrame, by: Sequence[str] = ("key",), lags: int = LAGS) -> DataFrame:
    """Normal equations to models, one row per series."""
    fields = {f.name: f.dataType.simpleString() for f in equations.schema.fields}
    keep = ", ".join(f"`{c}` {fields[c]}" for c in (*by, "n", "last_ts", "last_value", "tail"))
    return equations.mapInPandas(_solve(lags, by), f"{keep}, phi array<double>, status string")


def fit(
    series: DataFrame, by: Sequence[str] = ("key",), ts: str = "ts", value: str = "total", lags: int = LAGS
) -> DataFrame:
    """One model row per series: ``phi``, ``status`` and the series' end.

    ``singular`` models (constant slope, short series) still forecast; ``insufficient`` ones have
    null ``phi`` and publish nothing, nor do ``failed`` ones, whose values are missing or infinite.
    """
    return solve(normal_equations(series, by, ts, value, lags), by, lags)


def forecast(
    models: DataFrame, horizon: int = LIVE_HORIZON, by: Sequence[str] = ("key",), minutes: int = 1
) -> DataFrame:
    """``(*by, step, ts, forecast)`` for steps 1 to ``horizon``, ``minutes`` apart from the last point on."""
    phi = F.col("phi")

    def advance(state, _):
        terms = F.zip_with(phi, state["tail"], lambda a, b: a * b)
        d = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
        value = state["value"] + d
        tail = F.concat(F.array(d), F.slice(state["tail"], 1, F.size(state["tail"]) - 1))
        return F.struct(tail.alias("tail"), value.alias("value"), F.concat(state["path"], F.array(value)).alias("path"))

    start = F.struct(
        F.col("tail"), F.col("last_value").alias("value"), F.array().cast("array<double>").alias("path")
    )
    steps = F.sequence(F.lit(1), F.lit(horizon))
    paths = models.filter(phi.isNotNull()).select(
        *by, "last_ts", F.aggregate(steps, start, advance, lambda s: s["path"]).alias("path")
    )
    rows = paths.select(*by, "last_ts", F.posexplode("path").alias("_at", "forecast"))
    step = F.col("_at") + 1
    zero = F.lit(0)
    ahead = F.make_dt_interval(zero, zero, step * minutes, zero)
    return rows.select(*by, step.alias("step"), (F.col("last_ts") + ahead).alias("ts"), "forecast")
