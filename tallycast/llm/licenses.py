"""Licence scans by diagonal voting.

Rolling hashes of GRAM words of every document are joined with the positions of the same hashes in the templates. A match votes
for the diagonal (document position less template position). A phrase stands at a place if its diagonal has all its votes. For
longer templates, diagonals at most DRIFT apart are merged, which allows for words added or left out, and a merged span is accepted
if it covers enough of the template's positions and isn't much longer than the template, or if one of its diagonals covers enough alone.

Words are runs of A-Z (lower-cased), a-z, 0-9 and any character beyond ASCII. Hashes that are in no template are dropped where they
arise, as the join would do; the set of template hashes is bounded by the templates.

Defined cases: a null or empty text has no words, no labels, score 0 and null places; every row is returned, also repeated ones and
those of null keys; a match never crosses documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.llm.table import Table
from tallycast.llm.text import ALNUM, SHINGLE_BASE, Words, column_bytes, mix, pieces, words

GRAM = 2
DRIFT = 3
COVERED = 0.75
# The phrases whose places are counted, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Usual notices, as their licences print them, and the labels given to texts that hold most of one.
NOTICES = {
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction": "mit-text",
    "licensed under the apache license version 2 0": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation": "gpl-text",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd-text",
}


def grams(found: Words, size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words that stays in its text, and the index of its first word."""
    count = max(len(found.hashes) - size + 1, 0)
    total = np.zeros(count, np.uint64)
    for j in range(size):
        total = total * SHINGLE_BASE + found.hashes[j : j + count]
    at = np.arange(count)
    inside = at + size <= np.repeat(found.first[1:], found.counts)[:count]
    return mix(total[inside]), at[inside]


def templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """A row for each rolling hash of each template; a template has at most 63 of them."""
    rows = []
    for template, (text, label) in enumerate([*phrases.items(), *notices.items()]):
        hashes, at = grams(words(*column_bytes(pa.array([text])), ALNUM))
        if not 0 < len(at) < 64:
            raise ValueError(f"a template needs {GRAM} to {GRAM + 62} words: {text!r}")
        for gram, place in zip(hashes.view(np.int64).tolist(), at.tolist(), strict=True):
            rows.append((gram, template, label, template < len(phrases), len(at), place))
    return spark.createDataFrame(rows, "gram bigint, template int, label string, phrase boolean, size int, place int")


def hits(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Every row's word count, and the places and hashes of its runs that are in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table.of(wanted, np.arange(len(wanted)))
        for batch in pieces(batches, "text"):
            found = words(*column_bytes(batch.column("text")), ALNUM)
            hashes, at = grams(found)
            keep = table.get(hashes) >= 0
            hashes, at = hashes[keep], at[keep]
            row = np.searchsorted(found.first, at, "right") - 1
            ends = np.searchsorted(at, found.first).astype(np.int32)
            each = pa.StructArray.from_arrays(
                [pa.array(at - found.first[row], pa.int64()), pa.array(hashes.view(np.int64))], names=["at", "gram"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("key"), pa.array(found.counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), each)],
                names=["row", "key", "n_words", "hits"],
            )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"row bigint, key {kind}, n_words bigint, hits array<struct<at: bigint, gram: bigint>>")


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
) -> DataFrame:
    """Places of the phrases and labels of every document.

    Columns: the key, n_words, n_base (places of phrases), first_word and last_word (their least and greatest start), base_labels,
    labels (with the notices'), score (the largest share of a template that stands in the text) and n_spans (accepted notices).
    """
    spark = docs.sparkSession
    known = templates(spark, PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    wanted = np.unique(np.array([row.gram for row in known.select("gram").collect()], np.int64)).view(np.uint64)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    matched = (
        hits(rows, wanted)
        .select("row", "key", "n_words", F.explode_outer("hits").alias("hit"))
        .select("row", "key", "n_words", "hit.at", "hit.gram")
        .join(F.broadcast(known), "gram", "left")  # bounded by the templates
    )
    diagonals = (
        matched.withColumn("diagonal", F.col("at") - F.col("place"))
        .groupBy("row", "key", "n_words", "template", "label", "phrase", "size", "diagonal")
        .agg(
            F.count("place").alias("votes"),
            F.min("at").alias("begin"),
            (F.max("at") + GRAM).alias("end"),
            F.bit_or(F.expr("shiftleft(1L, place)")).alias("covered"),
        )
    )
    along = W.partitionBy("row", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(along) > DRIFT) | F.col("phrase")
    spans = (
        diagonals.withColumn("opens", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("opens").over(along))
        .groupBy("row", "key", "n_words", "template", "label", "phrase", "size", "span")
        .agg(
            F.min("diagonal").alias("diagonal"),
            F.bit_count(F.bit_or("covered")).alias("covered"),
            F.max(F.bit_count("covered")).alias("best"),
            F.min("begin").alias("begin"),
            F.max("end").alias("end"),
        )
        .withColumn("share", F.col("covered") / F.col("size"))
    )
    base = F.col("phrase") & (F.col("covered") == F.col("size"))
    length = F.col("end") - F.col("begin")
    # Words of the template beside a notice may lengthen its span; one diagonal that covers enough is the notice all the same.
    fits = (length <= 2 * (F.col("size") + GRAM)) | (F.col("best") >= COVERED * F.col("size"))
    notice = ~F.col("phrase") & (F.col("share") >= COVERED) & fits
    listed = lambda taken: F.concat_ws(",", F.sort_array(F.collect_set(F.when(taken, F.col("label")))))
    return (
        spans.groupBy("row", "key", "n_words")
        .agg(
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("diagonal"))).alias("first_word"),
            F.max(F.when(base, F.col("diagonal"))).alias("last_word"),
            listed(base).alias("base_labels"),
            listed(base | notice).alias("labels"),
            F.coalesce(F.max(F.when(base | ~F.col("phrase"), F.least("share", F.lit(1.0)))), F.lit(0.0)).alias("score"),
            F.count(F.when(notice, 1)).alias("n_spans"),
        )
        .drop("row")
        .withColumnRenamed("key", key)
    )
