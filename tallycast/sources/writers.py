"""Sinks and the model registry."""

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_per_key_csv(df: DataFrame, folder: str, key: str = "key") -> None:
    """One sub-folder of CSV files with header per key, replacing earlier content.

    Rows are not gathered by key first: each task writes its own share of a hot key.
    """
    df.withColumnRenamed(key, "key").write.mode("overwrite").partitionBy("key").csv(folder, header=True)


def append_csv(df: DataFrame, folder: str, header: bool = False) -> None:
    df.write.mode("append").csv(folder, header=header)


def json_messages(df: DataFrame, key: str = "key") -> DataFrame:
    """Each row as ``(key, value)``: the whole row as JSON text."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def write_messages(messages: DataFrame, target: str, format: str = "text", **options: str) -> None:
    """Append ready messages. ``text`` writes one message per line; ``kafka`` sends to topic ``target``.

    A failed send fails the job, and Spark reports and retries its tasks.
    """
    writer = messages.write.format(format).mode("append").options(**options)
    if format == "kafka":
        writer.option("topic", target).save()
    else:
        messages.select("value").write.format(format).mode("append").options(**options).save(target)


def write_topics(messages: DataFrame, folder: str, topic: Column) -> None:
    """Append ready messages to a folder per topic, one message per line: the file form of several topics."""
    messages.select("value", topic.alias("topic")).write.mode("append").partitionBy("topic").text(folder)


def save_models(models: DataFrame, folder: str, run: str) -> None:
    """Store the models of all keys of one run and their schema, replacing that run only."""
    models.write.mode("overwrite").parquet(f"{folder}/run={run}")
    schema = models.sparkSession.createDataFrame([(models.schema.json(),)], "value string")
    schema.coalesce(1).write.mode("overwrite").text(f"{folder}/_schema/run={run}")


def load_models(spark: SparkSession, folder: str, run: str | None = None) -> DataFrame:
    """Models of one run, or of all runs (of one kind of model) with their ``run`` column; the schema is the stored one."""
    stored = spark.read.text(f"{folder}/_schema" + (f"/run={run}" if run is not None else "")).select("value").distinct()
    kinds = [T.StructType.fromJson(json.loads(row.value)) for row in stored.limit(2).collect()]
    if len(kinds) != 1:
        raise ValueError(f"{len(kinds) or 'no'} kinds of models in {folder}: name a run")
    if run is not None:
        return spark.read.schema(kinds[0]).parquet(f"{folder}/run={run}")
    return spark.read.schema(T.StructType([*kinds[0].fields, T.StructField("run", T.StringType())])).parquet(folder)
