"""Forecasts as they were published at each refit.

A refit sees everything that had arrived at its trigger. The history is kept as parts
``(key, epoch_minute, interval, n, first_arrival, last_arrival, latest_ts, total)``: one row per
key and minute, split where a trigger falls into the minute, with the running total at the part's newest
event. Later parts of a minute hold later arrivals. Every snapshot is a union of whole parts, so events are read once and never again.
"""

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.functions import stretches
from tallycast.functions.times import minute_start
from tallycast.operators import autoregression as ar
from tallycast.operators.lagsums import map_versions
from tallycast.operators.series import fill_minutes, minute_totals
from tallycast.operators.triggers import every_interval, numbered, place
from tallycast.session import materialize

REFIT = ["interval", "key"]


def history_parts(events: DataFrame, triggers: DataFrame) -> DataFrame:
    """Parts of ``(key, ts, arrival)`` events, split at ``triggers``."""
    return minute_totals(place(events, triggers), split=["interval"])


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _final_series(parts: DataFrame, lags: int) -> DataFrame:
    """The whole history's series with running sums of its lag products."""
    totals = parts.groupBy("key", "epoch_minute").agg(F.max_by("total", F.struct("latest_ts", "last_arrival")).alias("total"))
    features = ar.lag_features(fill_minutes(totals), ts="epoch_minute", lags=lags)
    upto_here = W.partitionBy("key").orderBy("epoch_minute").rowsBetween(W.unboundedPreceding, W.currentRow)
    terms = ar.lag_products(F.col("d"), [F.col(f"l{i}") for i in range(1, lags + 1)])
    return features.select(
        F.col("key").alias("_key"),
        F.col("epoch_minute").alias("_minute"),
        F.col("total").alias("_final"),
        F.struct(*[F.sum(term).over(upto_here).alias(name) for name, term in terms.items()]).alias("_sums"),
    )


def _snapshot_ends(parts: DataFrame, n: int, lags: int) -> DataFrame:
    """Per refit and key: the last minute known, and the first minute not yet ``settled``.

    Minutes before ``settled`` get no later event, so there the snapshot equals the final series.
    In a stream in order only the last minute can be unsettled. Returns one row per minute from a
    little before ``settled`` (for the lags) to the end.
    """
    touched = parts.groupBy(*REFIT).agg(F.min("epoch_minute").alias("lo"), F.max("epoch_minute").alias("hi"))
    by_interval = W.partitionBy("key").orderBy("interval")
    known = F.max("hi").over(by_interval.rowsBetween(W.unboundedPreceding, W.currentRow))
    later = F.min("lo").over(by_interval.rowsBetween(1, W.unboundedFollowing))
    ends = (
        every_interval(touched, n)
        .unionByName(touched, allowMissingColumns=True)
        .groupBy(*REFIT)
        .agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"))
        .withColumns({"end": known, "later": later})
        .filter((F.col("interval") < n) & F.col("end").isNotNull())
        .withColumn("settled", F.least(F.coalesce("later", F.col("end") + 1), F.col("end") + 1))
    )
    minutes = F.sequence(F.col("settled") - 1 - lags, F.col("end"))
    return ends.select(*REFIT, "settled", F.explode(minutes).alias("epoch_minute"))


def refit_equations(parts: DataFrame, n: int, lags: int = ar.LAGS) -> DataFrame:
    """Normal equations of the series each refit saw, exact for events in any order.

    The settled minutes contribute the final series' running sums, read off at the last of them;
    only the few minutes after that are worked out per refit. So the work grows with minutes plus
    refits, not with their product.
    """
    series = _snapshot_series(parts, _final_series(parts, lags), n, lags)
    is_settled = F.col("epoch_minute") < F.col("settled")
    features = ar.lag_features(series, REFIT, "epoch_minute", lags=lags)
    added = ar.lag_products(F.col("d"), [F.col(f"l{i}") for i in range(1, lags + 1)])
    # Running sums are read at the last settled minute; unsettled minutes add their own products.
    at_settled = F.col("epoch_minute") == F.col("settled") - 1
    sums = [
        F.sum(F.when(at_settled, F.col("_sums")[name]).when(~is_settled, term).otherwise(0)).alias(name)
        for name, term in added.items()
    ]
    last = F.struct(
        minute_start(F.col("epoch_minute")).alias("last_ts"),
        F.col("total").cast("double").alias("last_value"),
        ar.recent(lags).alias("tail"),
    )
    equations = features.groupBy(*REFIT).agg(*sums, F.max_by(last, F.col("epoch_minute")).alias("_last"))
    return equations.select("*", "_last.*").drop("_last")


def _snapshot_series(parts: DataFrame, final: DataFrame, n: int, lags: int) -> DataFrame:
    """Per refit and key the minutes from a little before ``settled`` to the end, with their totals and the final series' ``_sums``."""
    ends = _snapshot_ends(parts, n, lags)
    pieces = parts.select(
        F.col("key").alias("_pkey"), F.col("epoch_minute").alias("_pminute"), F.col("interval").alias("_pinterval"),
        F.struct("latest_ts", "last_arrival").alias("_newest"), F.col("total").alias("_ptotal"),
    )
    arrived = (
        (F.col("epoch_minute") >= F.col("settled"))
        & _same("key", "_pkey")
        & (F.col("epoch_minute") == F.col("_pminute"))
        & (F.col("interval") >= F.col("_pinterval"))
    )
    own = ends.join(pieces, arrived, "left").groupBy(*REFIT, "settled", "epoch_minute").agg(
        F.max_by("_ptotal", "_newest").alias("_own")
    )
    values = own.join(final, _same("key", "_key") & (F.col("epoch_minute") == F.col("_minute")), "left")
    is_settled = F.col("epoch_minute") < F.col("settled")
    so_far = W.partitionBy(*REFIT).orderBy("epoch_minute").rowsBetween(W.unboundedPreceding, W.currentRow)
    total = F.last(F.when(is_settled, F.col("_final")).otherwise(F.col("_own")), ignorenulls=True).over(so_far)
    return values.withColumn("total", total).filter(F.col("total").isNotNull())


def refit_summaries(parts: DataFrame, lags: int = ar.LAGS) -> DataFrame:
    """The summaries of each series as refits saw it, ``(key, interval, SUMMARY)``, exact for events in any order.

    A row holds from its interval to the series' next row: there is one where a part came, and none for refits without news. A row costs the
    series' minutes, so long series are passed in blocks, the block a field of the key. A key's parts meet in one task.
    """
    newest = F.struct("latest_ts", "last_arrival", "total")
    upto_here = W.partitionBy("key", "epoch_minute").orderBy("interval").rowsBetween(W.unboundedPreceding, W.currentRow)
    changes = (
        parts.repartition("key")  # the one shuffle: what follows is by key and more
        .groupBy("key", "epoch_minute", "interval")
        .agg(F.max(newest).alias("_newest"))
        .withColumn("total", F.max("_newest").over(upto_here)["total"].cast("double"))
    )
    gathered = changes.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("interval", "epoch_minute", "total"))).alias("parts"))

    def fold(x: dict[str, pa.Array]) -> stretches.Versions:
        return stretches.versions_of(*(x[name].to_numpy() for name in ("interval", "epoch_minute", "total")), lags)

    return map_versions(gathered, fold, ["key"])


def refit_models(parts: DataFrame, triggers: DataFrame, lags: int = ar.LAGS) -> DataFrame:
    """One model per trigger and key that had history then: ``refit_arrival, refit_ts`` and the fit.

    ``parts`` and ``triggers`` are small next to the events and are read several times: pass
    materialized tables.
    """
    n = triggers.count()
    pieces = place(parts.drop("interval").withColumn("arrival", F.col("last_arrival")), triggers)
    models = ar.solve(refit_equations(pieces, n, lags), REFIT, lags)
    refits = numbered(triggers).select(
        "interval", F.col("arrival").alias("refit_arrival"), F.col("ts").alias("refit_ts")
    )
    return refits.join(models, "interval").drop("interval")


def refit_histories(parts: DataFrame, triggers: DataFrame) -> DataFrame:
    """The series each refit saw: ``(refit_arrival, key, ts, total)`` per minute, forward filled.

    Every refit's whole history is the answer, so the rows are refits times minutes. ``parts`` and
    ``triggers`` are read several times: pass materialized tables.
    """
    n = triggers.count()
    placed = place(parts.drop("interval").withColumn("arrival", F.col("last_arrival")), triggers).filter(F.col("interval") < n)
    later = F.explode(F.sequence("interval", F.lit(max(n - 1, 0)).cast("bigint")))
    newest = F.struct("latest_ts", "last_arrival")
    seen = placed.withColumn("interval", later).groupBy(*REFIT, "epoch_minute").agg(F.max_by("total", newest).alias("total"))
    refits = numbered(triggers).select("interval", F.col("arrival").alias("refit_arrival"))
    filled = fill_minutes(seen, REFIT).join(F.broadcast(refits) if n < 100_000 else refits, "interval")
    return filled.select("refit_arrival", "key", minute_start(F.col("epoch_minute")).alias("ts"), "total")


def refit_forecasts(
    events: DataFrame, triggers: DataFrame, lags: int = ar.LAGS, horizon: int = ar.LIVE_HORIZON
) -> DataFrame:
    """``(refit_arrival, refit_ts, key, step, ts, forecast)`` for every trigger, over whole histories."""
    triggers = materialize(triggers, "triggers")
    parts = materialize(history_parts(events, triggers), "parts")
    by = ["refit_arrival", "refit_ts", "key"]
    return ar.forecast(refit_models(parts, triggers, lags), horizon, by)
