"""Time slots, their counts and cumulative counts.

``slot="time_of_day"`` folds all days onto 1 440 (hour, minute) slots;
``slot="minute"`` keeps the real minute.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.functions.times import epoch_minute, minute_start, slot_clock, slot_on_day
from tallycast.operators.prefix import prefix_sums

SLOT = ["hour", "minute"]


def slot_counts(events: DataFrame, key: str = "key", ts: str = "ts", slot: str = "time_of_day") -> DataFrame:
    """Events per slot and key. Partial aggregation leaves at most one row per slot and key to shuffle."""
    if slot == "minute":
        minutes = events.groupBy(key, epoch_minute(F.col(ts)).alias("epoch_minute"))
        return minutes.agg(F.count("*").alias("votes"))
    return events.groupBy(F.hour(ts).alias("hour"), F.minute(ts).alias("minute"), key).agg(
        F.count("*").alias("votes")
    )


def slot_counts_all(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Events per time-of-day slot over all keys."""
    return events.groupBy(F.hour(ts).alias("hour"), F.minute(ts).alias("minute")).agg(
        F.count("*").alias("votes")
    )


def cumulative_slots(events: DataFrame, key: str = "key", ts: str = "ts", slot: str = "time_of_day") -> DataFrame:
    """Slot counts with the running sum per key; only slots that hold events appear.

    The time-of-day window sees at most 1 440 rows per key however many events there are.
    Real minutes are unbounded and go through the blockwise prefix sum.
    """
    counts = slot_counts(events, key, ts, slot)
    if slot == "minute":
        summed = prefix_sums(counts, [key], "epoch_minute", F.col("votes"), "cumulative_votes")
        return summed.withColumn("ts", minute_start(F.col("epoch_minute"))).drop("epoch_minute")
    upto_here = W.partitionBy(key).orderBy(*SLOT).rowsBetween(W.unboundedPreceding, W.currentRow)
    return counts.withColumn("cumulative_votes", F.sum("votes").over(upto_here))


def slot_time_series(slots: DataFrame, day: str = "2024-01-01") -> DataFrame:
    """Slots with their clock text and their timestamp on an anchor day, for time axes."""
    hour, minute = F.col("hour"), F.col("minute")
    return slots.withColumns({"clock": slot_clock(hour, minute), "slot_ts": slot_on_day(hour, minute, day)})
