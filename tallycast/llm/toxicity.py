"""Toxicity by two Kneser-Ney models, one for each class, that share their backoff.

A word's count in a class is the number of different words before it there (its continuation count), so copies of one
document count once. The class model discounts it and gives the freed mass to the continuation counts of the word's
first bytes, these likewise to counts of both classes together: a rare or unseen form of an expression is judged
by its beginning, and ordinary words cancel out. A document's features are its log-likelihood ratio per word, the highest
per word in a window, and the highest of one word; a logistic curve fitted on labelled rows of another fold turns them into
a score.

The models learn from at most PER_CLASS labelled rows of each class and fold, drawn by a hash of the id; they keep the
MAX_ENTRIES most frequent words and beginnings. Both bounds hold at every size, so the model can be broadcast. Everything is scored.

Defined cases: null or empty texts, and texts without words, have features 0; without labelled rows of both classes every
score is the share of label 1 among them, or 0 without any; labels that are null or whose ids have no document are left out, and a
document labelled twice is toxic if one label says so; a null id counts as the empty text in the folds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast.llm.table import Table
from tallycast.llm.text import ALNUM, column_bytes, pieces, prefix_hashes, words
from tallycast.session import materialize

FOLDS = 5
HELD_OUT = 0
CALIBRATION = 1
PER_CLASS = 4000
MAX_ENTRIES = 1 << 18
BEGINNING = 5  # bytes
DOUBT = 2.0  # standard deviations
WINDOW = 8  # words


def fold(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS


def drawn(labels: DataFrame, key: str, label: str) -> DataFrame:
    """Ids, classes and folds of the labelled rows to learn from, at most about PER_CLASS of a class for each use."""
    known = (
        labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg((F.max(label) > 0).cast("int").alias("toxic"))
        .withColumn("use", F.when(fold("key") == CALIBRATION, 1).otherwise(0))
        .filter(fold("key") != HELD_OUT)
    )
    sizes = known.groupBy("toxic", "use").count().collect()
    keep = F.lit(False)
    for row in sizes:
        share = min(1.0, PER_CLASS / row["count"])
        ticket = F.pmod(F.xxhash64("key"), F.lit(1 << 20))
        keep = keep | ((F.col("toxic") == row.toxic) & (F.col("use") == row.use) & (ticket < int(share * (1 << 20))))
    return known.filter(keep)


def continuations(rows: DataFrame) -> DataFrame:
    """Different contexts of each word of each class: class, word, its beginning, and the word before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            data, offsets = column_bytes(batch.column("text"))
            found = words(data, offsets, ALNUM)
            begins = prefix_hashes(data, found, BEGINNING, ALNUM)
            before = np.zeros(len(found.hashes), np.uint64)
            before[1:] = found.hashes[:-1]
            before[found.first[:-1][found.counts > 0]] = 0
            toxic = batch.column("toxic").to_numpy()[found.rows].astype(np.int32)
            _, at = np.unique(found.hashes * np.uint64(3) + before * np.uint64(5) + toxic.astype(np.uint64), return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(toxic[at])] + [pa.array(x[at].view(np.int64)) for x in (found.hashes, begins, before)],
                names=["toxic", "word", "beginning", "before"],
            )

    return rows.select("toxic", "text").mapInArrow(run, "toxic int, word bigint, beginning bigint, before bigint").distinct()


@dataclass
class Model:
    """Log ratios of words, and of beginnings for other words; then the logistic curve over the features."""

    word_keys: np.ndarray
    word_ratios: np.ndarray
    beginning_keys: np.ndarray
    beginning_ratios: np.ndarray
    other_ratio: float
    curve: np.ndarray | None = None  # weights of the features, then the constant

    def tables(self) -> tuple[Table, Table]:
        return (Table.of(self.word_keys, np.arange(len(self.word_keys))), Table.of(self.beginning_keys, np.arange(len(self.beginning_keys))))

    def features(self, tables: tuple[Table, Table], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        found = words(data, offsets, ALNUM)
        at = tables[0].get(found.hashes)
        start = tables[1].get(prefix_hashes(data, found, BEGINNING, ALNUM))
        # The last element stands for what the tables lack (-1).
        ratio = np.append(self.beginning_ratios, self.other_ratio)[start]
        ratio = np.where(at >= 0, np.append(self.word_ratios, 0)[at], ratio)
        total = np.concatenate([[0.0], np.cumsum(ratio)])
        out = np.zeros((len(offsets) - 1, 3))
        filled = np.flatnonzero(found.counts)
        if not len(filled):
            return out
        first, counts = found.first[:-1][filled], found.counts[filled]
        out[filled, 0] = (total[first + counts] - total[first]) / counts
        end = np.minimum(np.arange(len(ratio)) + WINDOW, np.repeat(first + counts, counts))
        begin = np.maximum(end - WINDOW, np.repeat(first, counts))
        out[filled, 1] = np.maximum.reduceat((total[end] - total[begin]) / (end - begin), first)
        out[filled, 2] = np.maximum.reduceat(ratio, first)
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.clip(features @ self.curve[:-1] + self.curve[-1], -30, 30)
        return 1 / (1 + np.exp(-z))


def discounted(counts: np.ndarray, total: float, ones: float, twos: float) -> tuple[np.ndarray, float]:
    """Shares after the discount, and the mass that it leaves to the backoff.

    To the Kneser-Ney discount come DOUBT standard deviations of the count, so that a few chance contexts tell nothing.
    """
    discount = ones / (ones + 2 * twos) if ones else 0.5
    total = max(total, 1.0)
    shares = np.maximum(counts - discount - DOUBT * np.sqrt(counts), 0) / total
    return shares, max(1 - shares.sum(), 0.5 / total)


def counts_by_class(pairs: DataFrame, name: str) -> tuple[DataFrame, dict]:
    """Continuation counts of each item of a column in both classes, and the sums that smoothing needs."""
    other = ["beginning"] if name == "word" else []
    items = pairs.groupBy(name, *other).agg(
        *(F.count(F.when(F.col("toxic") == c, 1)).alias(f"n{c}") for c in (0, 1))
    )
    sums = items.agg(
        *(
            expr
            for c in (0, 1)
            for expr in (
                F.sum(f"n{c}").alias(f"total{c}"),
                F.count(F.when(F.col(f"n{c}") == 1, 1)).alias(f"ones{c}"),
                F.count(F.when(F.col(f"n{c}") == 2, 1)).alias(f"twos{c}"),
            )
        )
    ).first()
    top = items.filter(F.col("n0") + F.col("n1") > 1).orderBy((F.col("n0") + F.col("n1")).desc(), name).limit(MAX_ENTRIES)
    return top, sums.asDict()


def smooth(pairs: DataFrame) -> Model:
    """The two smoothed models as log ratios."""
    top, sums = counts_by_class(pairs.select("toxic", "beginning", "before").distinct(), "beginning")
    begins = top.toPandas()
    pooled = (begins.n0 + begins.n1).to_numpy(float)
    everything = float(sums["total0"] + sums["total1"])
    shared = (pooled + 0.5) / (everything + 1)
    shares, masses = [], []
    for c in (0, 1):
        share, mass = discounted(begins[f"n{c}"].to_numpy(float), *(float(sums[f"{x}{c}"] or 0) for x in ("total", "ones", "twos")))
        shares.append(share + mass * shared)
        masses.append(mass)
    other = np.log(masses[1]) - np.log(masses[0])

    top, sums = counts_by_class(pairs, "word")
    entries = top.toPandas()
    place = {key: i for i, key in enumerate(begins.beginning.tolist())}
    at = np.array([place.get(key, -1) for key in entries.beginning.tolist()], np.int64)
    own = (entries.n0 + entries.n1).to_numpy(float)
    within = np.minimum((own + 0.5) / (np.where(at >= 0, pooled[at] if len(pooled) else 0, own) + 1), 1)
    probability, freed = [], []
    for c in (0, 1):
        share, mass = discounted(entries[f"n{c}"].to_numpy(float), *(float(sums[f"{x}{c}"] or 0) for x in ("total", "ones", "twos")))
        below = np.where(at >= 0, shares[c][at] if len(pooled) else 0, masses[c] * 0.5 / (everything + 1))
        probability.append(share + mass * below * within)
        freed.append(np.log(mass))
    shift = freed[1] - freed[0]
    return Model(
        entries.word.to_numpy(np.int64).view(np.uint64),
        np.log(probability[1]) - np.log(probability[0]),
        begins.beginning.to_numpy(np.int64).view(np.uint64),
        np.log(shares[1]) - np.log(shares[0]) + shift,
        float(other + shift),
    )


def logistic(features: np.ndarray, toxic: np.ndarray, strength: float = 0.001) -> np.ndarray:
    """Weights of a ridge-penalised logistic curve, by Newton's method."""
    x = np.column_stack([features, np.ones(len(features))])
    share = np.full(len(features), 1 / max(len(features), 1))
    weights, penalty = np.zeros(x.shape[1]), strength * np.diag([1.0] * features.shape[1] + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (share * (p - toxic)) + penalty @ weights
        curvature = (x * (share * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(x.shape[1])
        step = np.linalg.solve(curvature, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Train on the drawn labelled rows. Runs Spark jobs; what it returns is bounded by MAX_ENTRIES."""
    chosen = materialize(drawn(labels, key, label), "toxic-ids")
    # At most four times PER_CLASS ids: broadcast.
    rows = materialize(
        docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key"), "toxic-rows"
    )
    # Labels whose ids have no document don't count.
    classes = {(row.toxic, row.use): row["count"] for row in rows.groupBy("toxic", "use").count().collect()}
    constant = Model(*(np.zeros(0, np.uint64), np.zeros(0)) * 2, 0.0)
    share = sum(n for (toxic, _), n in classes.items() if toxic) / max(sum(classes.values()), 1)
    constant.curve = np.array([0, 0, 0, np.log(share / (1 - share)) if 0 < share < 1 else 60 * share - 30])
    if not all(classes.get((c, 0)) for c in (0, 1)):
        return constant
    model = smooth(materialize(continuations(rows.filter("use = 0")), "toxic-pairs"))
    check = 1 if all(classes.get((c, 1)) for c in (0, 1)) else 0
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        tables = model.tables()
        for batch in pieces(batches, "text"):
            found = model.features(tables, *column_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(x) for x in found.T.copy())], names=["toxic", "a", "b", "c"])

    seen = rows.filter(F.col("use") == check).select("toxic", "text").mapInArrow(run, "toxic int, a double, b double, c double").toPandas()
    model.curve = logistic(seen[["a", "b", "c"]].to_numpy(), seen.toxic.to_numpy())
    return model


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score ``out``, in one pass over the texts without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        tables = model.tables()
        for batch in pieces(batches, text):
            found = model.features(tables, *column_bytes(batch.column(text)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.score(found))], names=[*batch.schema.names, out]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels)
    scored = score(docs.select("doc_id", "text"), model).drop("text")
    return scored.select(
        "doc_id",
        (fold() == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
