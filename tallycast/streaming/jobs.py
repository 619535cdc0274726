"""Streaming forms of the operators: a streaming DataFrame in, a streaming DataFrame out."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.functions.times import epoch_minute, minute_start


def running_totals(events: DataFrame, key: str = "key") -> DataFrame:
    """Running count per key; state is one row per key, and counts are combined before the shuffle."""
    return events.groupBy(key).agg(F.count("*").alias("running_total"))


def hourly_counts(events: DataFrame, key: str = "key", ts: str = "ts") -> DataFrame:
    """Tumbling one-hour counts per key, for update mode; every event counts, however late.

    There is no watermark, which would discard late events: the state is one row per key and hour that holds
    events, as many as the answer has. Zone-less times are cut to the hour as they are, whatever the session zone.
    """
    hour = F.floor(epoch_minute(F.col(ts)) / 60).cast("bigint")
    hours = events.groupBy(key, hour.alias("_hour")).agg(F.count("*").alias("n"))
    return hours.select(key, minute_start(F.col("_hour") * 60).alias("hour_start"), "n")


def latest_per_key(messages: DataFrame, key: str = "key", offset: str = "offset") -> DataFrame:
    """The newest message of each key; state is one message per key."""
    rest = [c for c in messages.columns if c != key]
    newest = messages.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(offset)).alias("_newest"))
    return newest.select(key, *[F.col("_newest")[c].alias(c) for c in rest])
