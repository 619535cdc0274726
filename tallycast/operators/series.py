"""Per-key series over arrival order and over real minutes.

``arrival`` is a bigint, unique per event, that grows in the order the events arrived;
``ts`` is the event's own time. The two may disagree (late events).
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.functions.times import epoch_minute, minute_start
from tallycast.operators.prefix import prefix_sums
from tallycast.session import materialize


def running_totals(events: DataFrame, key: str = "key", arrival: str = "arrival") -> DataFrame:
    """Each event with its key's count so far, itself included."""
    return prefix_sums(events, [key], arrival, F.lit(1).cast("bigint"), "running_total")


def last_seen(events: DataFrame, key: str = "key", ts: str = "ts") -> DataFrame:
    return events.groupBy(key).agg(F.max(ts).alias("last_ts"))


def minute_totals(
    events: DataFrame, key: str = "key", ts: str = "ts", arrival: str = "arrival", split: Sequence[str] = ()
) -> DataFrame:
    """Running total carried by the newest event of each minute that holds events.

    The newest event has the latest time, among equals the last arrival; its running total counts
    what had arrived up to it. ``(key, epoch_minute, n, first_arrival, last_arrival, latest_ts,
    total)``, with ``split`` columns a row per part of a minute.

    Where the arrival ranges of a key's rows do not overlap and the newest event came last, which
    is everywhere in a stream in order, sums of counts are already the answer and no event is
    shuffled. Only events of the other rows (late arrivals) are ranked one by one.
    """
    narrow = events.select(key, *split, arrival, ts, epoch_minute(F.col(ts)).alias("epoch_minute"))
    part = [key, "epoch_minute", *split]
    counts = narrow.groupBy(*part).agg(
        F.count("*").alias("n"),
        F.min(arrival).alias("first_arrival"),
        F.max(arrival).alias("last_arrival"),
        F.max(ts).alias("latest_ts"),
        F.max_by(ts, arrival).alias("_last_ts"),
    )

    # Windows over one row per key and minute: bounded by the calendar, not by the events.
    by_arrival = W.partitionBy(key).orderBy("first_arrival", "last_arrival")
    before = by_arrival.rowsBetween(W.unboundedPreceding, -1)
    upto_here = by_arrival.rowsBetween(W.unboundedPreceding, W.currentRow)
    overlaps = F.coalesce(F.col("first_arrival") <= F.max("last_arrival").over(before), F.lit(False))
    runs = counts.withColumn("_overlaps", overlaps)
    shared = F.col("_overlaps") | F.lead("_overlaps", 1, False).over(by_arrival)
    runs = runs.withColumn("_mixed", shared | (F.col("_last_ts") < F.col("latest_ts")))
    runs = materialize(runs.withColumn("total", F.sum("n").over(upto_here)), "minutes")
    columns = ["n", "first_arrival", "last_arrival", "latest_ts"]
    if runs.filter("_mixed").isEmpty():
        return runs.select(*part, *columns, "total")

    # Rank the events of mixed rows among themselves, and add the plain rows before them.
    mixed = runs.filter("_mixed").select(*[F.col(c).alias(f"_{c}") for c in part])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in part])
    ranked = prefix_sums(narrow.join(mixed, same, "left_semi"), [key], arrival, F.lit(1).cast("bigint"), "_rank")
    ranks = ranked.groupBy(*part).agg(F.max_by("_rank", F.struct(ts, arrival)).alias("_rank"))
    plain_so_far = F.sum(F.when(~F.col("_mixed"), F.col("n")).otherwise(0)).over(upto_here)
    mixed_so_far = F.sum(F.when(F.col("_mixed"), F.col("n")).otherwise(0)).over(upto_here)
    runs = runs.withColumns({"_plain": plain_so_far, "_before": F.when(~F.col("_mixed"), mixed_so_far)})
    # One row on either side: a union with an aggregate keeps null keys together.
    return (
        runs.select(*part, *columns, "_plain", "_before")
        .unionByName(ranks, allowMissingColumns=True)
        .groupBy(*part)
        .agg(
            *[F.max(c).alias(c) for c in columns],
            (F.max("_plain") + F.coalesce(F.max("_before"), F.max("_rank"))).alias("total"),
        )
    )


def fill_minutes(totals: DataFrame, by: Sequence[str] = ("key",)) -> DataFrame:
    """Regular one-minute grid from a series' first to its last minute, gaps filled forward.

    Each row spans up to the next row of its series, so no separate grid has to be joined.
    """
    by_minute = W.partitionBy(*by).orderBy("epoch_minute")
    until = F.coalesce(F.lead("epoch_minute").over(by_minute) - 1, F.col("epoch_minute"))
    spans = totals.withColumn("_until", until)
    return spans.withColumn("epoch_minute", F.explode(F.sequence("epoch_minute", "_until"))).drop("_until")


def minute_series(events: DataFrame, key: str = "key", ts: str = "ts", arrival: str = "arrival") -> DataFrame:
    """``(key, ts, total)`` per minute, forward filled."""
    totals = minute_totals(events, key, ts, arrival).select(key, "epoch_minute", "total")
    filled = fill_minutes(totals, [key])
    return filled.select(key, minute_start(F.col("epoch_minute")).alias("ts"), "total")


def monotonic_check(series: DataFrame, key: str = "key", ts: str = "ts", total: str = "total") -> DataFrame:
    """Per key: the number of points and whether the total ever decreases."""
    drop = F.col(total) < F.lag(total).over(W.partitionBy(key).orderBy(ts))
    return (
        series.withColumn("_drop", F.coalesce(drop, F.lit(False)))
        .groupBy(key)
        .agg(F.count("*").alias("points"), F.bool_or("_drop").alias("decreases"))
    )
