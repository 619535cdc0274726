"""When to refit, and what was known at that moment."""

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.operators.prefix import BLOCK_BITS, prefix_sums

OPENING_HOUR = 8  # fixed value: the hour in which no refit fires
LISTED_TRIGGERS = 100_000  # longest trigger list spread to every task (about 20 MB)
CROWDED = 32  # most intervals a row may be compared with


def _hour_changes(marks: DataFrame, window: WindowSpec) -> DataFrame:
    previous = F.lag("_hour").over(window)
    return marks.withColumn("_previous", previous).filter(
        F.col("_previous").isNull() | (F.col("_previous") != F.col("_hour"))
    ).drop("_previous")


def candidate_changes(
    events: DataFrame, ts: str = "ts", arrival: str = "arrival", opening_hour: int = OPENING_HOUR
) -> DataFrame:
    """Candidates, as ``(arrival, ts)``, thinned to where their hour changes.

    A candidate is an event in minute 0 of an hour other than the opening hour. One that repeats
    the hour of the candidate before it in arrival order never fires, and can be dropped without
    changing any later comparison; so blocks of arrivals are thinned independently. The first
    candidate of a block is always kept.
    """
    hour = F.hour(ts)
    marks = events.filter((F.minute(ts) == 0) & (hour != opening_hour)).select(arrival, ts, hour.alias("_hour"))
    block = F.shiftright(F.col(arrival), BLOCK_BITS)
    return _hour_changes(marks, W.partitionBy(block).orderBy(arrival)).select(arrival, ts)


def trigger_points(
    events: DataFrame, ts: str = "ts", arrival: str = "arrival", opening_hour: int = OPENING_HOUR
) -> DataFrame:
    """Events that fire a refit, as ``(arrival, ts)``: candidates whose predecessor had another hour of day.

    Each block of arrivals is settled by itself, but for its first candidate, which is compared with the last
    hour of the block before; so one task orders a row per block, however many candidates there are.
    """
    marks = candidate_changes(events, ts, arrival, opening_hour).withColumns(
        {"_hour": F.hour(ts), "_block": F.shiftright(F.col(arrival), BLOCK_BITS)}
    )
    blocks = marks.groupBy("_block").agg(F.min(arrival).alias("_first"), F.max_by("_hour", arrival).alias("_last"))
    carried = blocks.select("_block", "_first", F.lag("_last").over(W.orderBy("_block")).alias("_carried"))
    inside = F.lag("_hour").over(W.partitionBy("_block").orderBy(arrival))
    previous = F.coalesce(inside, F.col("_carried"))
    return (
        marks.join(carried, "_block")
        .withColumn("_previous", previous)
        .filter(F.col("_previous").isNull() | (F.col("_previous") != F.col("_hour")))
        .select(arrival, ts)
    )


def place(rows: DataFrame, triggers: DataFrame, arrival: str = "arrival", listed: int = LISTED_TRIGGERS) -> DataFrame:
    """Add ``interval``: how many triggers arrived before the row (so a trigger ends its own interval).

    A trigger list of at most ``listed`` entries (counted) is spread over blocks of arrivals about
    as wide as half the usual distance between triggers. That table, at most three rows per
    trigger, goes to every task, and a row meets only the few intervals that touch its block. A
    longer or very uneven list is merged with the rows in arrival order. ``triggers`` is read
    several times: pass a materialized table.
    """
    n, first, last = triggers.agg(F.count("*"), F.min(arrival), F.max(arrival)).first()
    if n == 0:
        return rows.withColumn("interval", F.lit(0).cast("bigint"))
    if n > listed:
        return _merge(rows, triggers, arrival)
    bits = ((last - first) // (2 * n)).bit_length()
    ordered = numbered(triggers.select(F.col(arrival).alias("_to")), "_to").withColumn(
        "_from", F.lag("_to").over(W.orderBy("_to"))
    )
    block = F.explode(F.sequence(F.shiftright("_from", bits), F.shiftright("_to", bits)))
    spans = ordered.filter(F.col("_from").isNotNull()).select("interval", "_from", "_to", block.alias("_block"))
    if n > CROWDED and not spans.groupBy("_block").count().filter(F.col("count") > CROWDED).isEmpty():
        return _merge(rows, triggers, arrival)
    at = F.col(arrival)
    inside = (F.shiftright(at, bits) == F.col("_block")) & (at > F.col("_from")) & (at <= F.col("_to"))
    interval = F.when(at <= first, 0).when(at > last, n).otherwise(F.col("interval"))
    return (
        rows.join(F.broadcast(spans), inside, "left")
        .withColumn("interval", interval.cast("bigint"))
        .drop("_from", "_to", "_block")
    )


def _merge(rows: DataFrame, triggers: DataFrame, arrival: str) -> DataFrame:
    """``place`` by a running count of triggers over rows and triggers in arrival order."""
    # A trigger shares its event's arrival: doubling makes room to sort it after the event.
    marked = rows.withColumns({"_order": F.col(arrival) * 2, "_trigger": F.lit(0), "_all": F.lit(0)})
    fired = triggers.select(
        (F.col(arrival) * 2 + 1).alias("_order"), F.lit(1).alias("_trigger"), F.lit(0).alias("_all")
    )
    merged = prefix_sums(
        marked.unionByName(fired, allowMissingColumns=True), ["_all"], "_order", F.col("_trigger"), "interval"
    )
    return merged.filter("_trigger = 0").drop("_order", "_trigger", "_all")


def numbered(triggers: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Triggers with their ``interval``, 0 for the first. One row per refit goes through one task."""
    return triggers.withColumn("interval", (F.row_number().over(W.orderBy(arrival)) - 1).cast("bigint"))


def every_interval(per_key: DataFrame, n: int, by: str = "key") -> DataFrame:
    """Each key with each of the ``n`` intervals."""
    intervals = F.sequence(F.lit(0).cast("bigint"), F.lit(max(n - 1, 0)).cast("bigint"))
    return per_key.select(by).distinct().select(by, F.explode(intervals).alias("interval"))


def snapshot_totals(
    events: DataFrame,
    triggers: DataFrame,
    key: str = "key",
    arrival: str = "arrival",
    listed: int = LISTED_TRIGGERS,
) -> DataFrame:
    """Total per key over everything that had arrived at each trigger, the trigger itself included.

    Events are counted per key and trigger interval, and the counts summed up over intervals; no
    event meets more than its own interval.
    """
    placed = place(events.select(key, arrival), triggers, arrival, listed)
    counts = placed.groupBy(key, "interval").agg(F.count("*").alias("n"))
    grid = every_interval(counts, triggers.count(), key).withColumn("n", F.lit(0))
    filled = counts.unionByName(grid).groupBy(key, "interval").agg(F.sum("n").alias("n"))
    upto_here = W.partitionBy(key).orderBy("interval").rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = filled.select(key, "interval", F.sum("n").over(upto_here).alias("total"))
    return numbered(triggers, arrival).join(totals, "interval").drop("interval")
