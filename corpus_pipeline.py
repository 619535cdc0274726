"""The corpus pipeline: what is left of the documents after each stage, and the packed sequences at its end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallycast.llm import stages
from tallycast.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.drop_toxic),
    ("near_dedup", stages.drop_near_copies),
    ("suffix_dedup", stages.cut_repeats),
    ("packing", stages.pack_documents),
]

#: The model, the sketches and the tokenizer can't be written as SQL; tests hold the rows against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
