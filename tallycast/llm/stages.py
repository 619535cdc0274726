"""The operators as pipeline stages: each takes the session, its predecessor's documents and the folder of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm import toxicity
from tallycast.llm.near import near_classes, text_node
from tallycast.llm.packing import pack
from tallycast.llm.repeats import without_repeats
from tallycast.llm.text import bound_arrow_batches


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the model learns from the labelled ones among them."""
    bound_arrow_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mark = "_toxicity"
    while mark in docs.columns:
        mark += "_"
    return toxicity.score(docs, model, out=mark).filter(F.col(mark) < 0.5).drop(mark)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one of the least id; a repeated row stays once."""
    bound_arrow_batches(spark)
    kept = near_classes(docs).filter("kept").select("doc_id", "node").distinct().alias("kept")
    same = F.col("docs.doc_id").eqNullSafe(F.col("kept.doc_id")) & (text_node("docs.text") == F.col("kept.node"))
    found = docs.alias("docs").join(kept, same, "left_semi")
    repeated = docs.groupBy("doc_id", text_node("text").alias("node")).count().filter("count > 1").limit(1).count()
    return found.dropDuplicates(["doc_id", "text"]) if repeated else found


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the bytes of strings of a hundred bytes that start earlier."""
    bound_arrow_batches(spark)
    return without_repeats(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    bound_arrow_batches(spark)
    return pack(docs)
