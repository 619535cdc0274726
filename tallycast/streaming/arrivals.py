"""Arrival numbers for messages that come without one."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.session import materialize

BATCH_BITS = 32  # a micro-batch holds fewer than 2**32 rows
INDEX_BITS = 33  # of Spark's increasing ids: the row's place in its partition
BROKER_ORDER = ("timestamp", "partition", "offset")


def numbered_arrivals(rows: DataFrame, batch_id: int, order: Sequence[str] = BROKER_ORDER) -> DataFrame:
    """Add ``arrival``: the micro-batch's number in the high bits, the rank in ``order`` within it in the low ones.

    With several broker partitions offsets repeat, so the rule is broker time, then partition, then offset; later
    batches have larger numbers. ``order`` must tell rows apart for a replay to give the same numbers. Rows are sorted by
    ranges, and only a count per range is summed up in one place.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("_range", F.shiftright("_at", INDEX_BITS)), "arrivals")
    counts = placed.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    bases = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_base"))  # a row per range
    index = F.col("_at").bitwiseAND((1 << INDEX_BITS) - 1)
    arrival = F.lit(batch_id << BATCH_BITS).cast("bigint") + F.col("_base") + index
    return placed.join(F.broadcast(bases), "_range").withColumn("arrival", arrival).drop("_at", "_range", "_base")
