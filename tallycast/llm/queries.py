"""The registered queries of the dealt operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallycast.llm import divergence, perspectives, secrets, topk, variants
from tallycast.llm.bpe import encode_decode
from tallycast.llm.fingerprint import edited_likeness
from tallycast.llm.licenses import scan
from tallycast.llm.near import near_classes
from tallycast.llm.packing import pack
from tallycast.llm.repeats import repeat_digests
from tallycast.llm.scoring import scores
from tallycast.llm.text import bound_arrow_batches
from tallycast.llm.toxicity import classify


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    bound_arrow_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_products(table(spark, folder, "embeddings"))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_classes(table(spark, folder, "documents")).drop("node")


def op3_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return repeat_digests(table(spark, folder, "documents"))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_likeness(table(spark, folder, "documents"))


def op5_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return perspectives.perspectives(table(spark, folder, "conversations"))


def op6_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return encode_decode(table(spark, folder, "documents"))


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents"))


def op9_log_frequency_scores(spark: SparkSession, folder: str) -> DataFrame:
    return scores(table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_variants(table(spark, folder, "documents"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


def op13_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_digests(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_top_products,
        op2_near_duplicates,
        op3_repeated_strings,
        op4_fingerprints,
        op5_perspectives,
        op6_bpe_codec,
        op7_best_fit_packing,
        op8_license_scan,
        op9_log_frequency_scores,
        op10_toxicity,
        op11_spelling_variants,
        op12_source_divergence,
        op13_secret_ledger,
    )
}

#: The others rest on hash sketches, automata, fitted models or byte positions; tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op1_top_products": topk.SQL,
    "op5_perspectives": perspectives.SQL,
    "op11_spelling_variants": variants.SQL,
    "op12_source_divergence": divergence.SQL,
    "op13_secret_ledger": secrets.SQL,
}
