"""Batch and streaming sources, always with an explicit schema."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallycast import schemas


def read_events_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw event records without header: columns by position. A header line is an ordinary bad record."""
    return spark.read.schema(schemas.RAW_EVENT).csv(paths, header=False)


def read_table_csv(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """A file with a header line (entity or key dimension, predictions, series, forecasts)."""
    return spark.read.schema(schema).csv(paths, header=True)


KEY_FOLDER = r"/key=([^/]+)/"


def key_from_path(pattern: str = KEY_FOLDER) -> Column:
    """The key held in the file's path: first group of ``pattern``.

    A path is a URI, so its escapes are undone. Only names that Spark gave to ``key=`` folders are
    escaped once more; in any other name a percent sign is just that.
    """
    decoded = lambda x: F.try_url_decode(F.regexp_replace(x, r"\+", "%2B"))
    path = F.col("_metadata.file_path")
    text = F.regexp_extract(F.coalesce(decoded(path), path), pattern, 1)
    return F.coalesce(decoded(text), text) if "key=" in pattern else text


def read_per_key_csv(
    spark: SparkSession, paths: str | list[str], schema: StructType, pattern: str = KEY_FOLDER, key: str = "key"
) -> DataFrame:
    """Files of all keys in one scan, the key taken from each file's path."""
    return read_table_csv(spark, paths, schema).withColumn(key, key_from_path(pattern))


def stream_files(spark: SparkSession, folder: str, schema: StructType, format: str = "json", **options: str) -> DataFrame:
    """A folder of files as a stream (``maxFilesPerTrigger`` and ``pathGlobFilter`` go in ``options``)."""
    return spark.readStream.schema(schema).options(**options).format(format).load(folder)


def stream_topics(spark: SparkSession, folder: str, topics: Sequence[str] | None = None, **options: str) -> DataFrame:
    """Messages ``(value, topic)`` of several topics as one stream, from a folder per topic; all of them, or those named.

    Topics that appear later are read from then on, as with a subscription by pattern.
    """
    stream = stream_files(spark, folder, spark.createDataFrame([], "value string, topic string").schema, "text", **options)
    return stream if topics is None else stream.filter(F.col("topic").isin(list(topics)))


def stream_kafka(spark: SparkSession, servers: str, topics: str, pattern: bool = False, **options: str) -> DataFrame:
    """One topic, a list, or a topic pattern, from the earliest offset.

    Progress lives in the query's checkpoint in place of committed offsets. Needs Spark's Kafka package.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern" if pattern else "subscribe", topics)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )


def decode_json(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """JSON text or bytes to columns; a missing field, or a malformed message, gives nulls."""
    rest = [c for c in messages.columns if c != value]
    return messages.select(*rest, F.from_json(F.col(value).cast("string"), schema).alias("_m")).select(*rest, "_m.*")


def live_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Live messages as raw events: ``entity, key, event_time, picture`` next to the other columns."""
    decoded = decode_json(messages, schemas.LIVE_EVENT, value)
    return decoded.withColumnsRenamed(
        {"Voter_id": "entity", "Candidate_id": "key", "Vote_Time": "event_time", "Voter_image": "picture"}
    )
