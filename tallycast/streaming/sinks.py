"""Micro-batch sink that survives replays."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

Transform = Callable[[DataFrame], DataFrame]


def save_batches(
    stream: DataFrame,
    folder: str,
    checkpoint: str,
    mode: str = "append",
    transform: Transform | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Write each micro-batch to its own ``batch_id=`` folder, replaced when the batch is replayed.

    ``transform`` is any batch operator; it runs with the optimizer's full batch plan.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        result = transform(batch) if transform else batch
        result.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_batches(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All batches written so far, with their ``batch_id``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return spark.read.schema(f"{fields}, batch_id bigint").parquet(folder)


def latest_rows(batches: DataFrame, keys: list[str]) -> DataFrame:
    """Update-mode output as a table: the newest row of each key wins."""
    rest = [c for c in batches.columns if c not in (*keys, "batch_id")]
    newest = batches.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_newest"))
    return newest.select(*keys, *[F.col("_newest")[c].alias(c) for c in rest])
