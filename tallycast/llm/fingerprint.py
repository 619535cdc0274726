"""Document fingerprints by one-permutation MinHash with optimal densification and packed low-order bits.

Each shingle (five words, white space between them, A-Z lower-cased) is hashed once: its high bits name a bin, the rest competes for the
bin's minimum. An empty bin draws other bins by a hash of its own number and the attempt, the same for all documents, until it
meets a filled one, and copies that. A fingerprint holds BITS low-order bits of each of BINS minima as hexadecimal text. The likeness
of two is the share of equal bins, less what BITS bits agree by chance.

Defined cases: a null or empty text, like any of fewer than five words, has one shingle; equal texts have equal fingerprints;
documents of equal id follow each other by a hash of their text, null ids come first; a single document is its own next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast.llm.text import GOLDEN, column_bytes, mix, pieces, shingles, words

BIN_BITS = 9
BINS = 1 << BIN_BITS
BITS = 4
EMPTY = np.uint64(2**64 - 1)
RANGES_PER_PARTITION = 4


def draws(attempt: int) -> np.ndarray:
    """The bin that each empty bin looks at in this attempt."""
    numbers = np.arange(BINS, dtype=np.uint64) + np.uint64(attempt) * np.uint64(BINS)
    return (mix(numbers * GOLDEN) % np.uint64(BINS)).astype(np.int64)


def densify(minima: np.ndarray) -> np.ndarray:
    """Fill the empty bins of each row; a row has a filled bin at least."""
    filled = minima != EMPTY
    out = minima.copy()
    alone = np.flatnonzero(filled.sum(axis=1) == 1)
    out[alone] = minima[alone].min(axis=1)[:, None]
    row, bin_ = np.nonzero(out == EMPTY)
    attempt = 0
    while len(row):
        attempt += 1
        source = draws(attempt)[bin_]
        found = filled[row, source]
        out[row[found], bin_[found]] = minima[row[found], source[found]]
        row, bin_ = row[~found], bin_[~found]
    return out


def sketches(column: pa.Array) -> np.ndarray:
    """The low-order bits of every bin, a row for each text."""
    found = words(*column_bytes(column))
    hashes, first = shingles(found)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    minima = np.full(((len(first) - 1) * BINS), EMPTY, np.uint64)
    bins = rows * BINS + (hashes >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    np.minimum.at(minima, bins, hashes & np.uint64((1 << (64 - BIN_BITS)) - 1))
    # Mixed with the bin's number, so that chance agreement of a copied minimum differs from bin to bin.
    salted = mix(densify(minima.reshape(-1, BINS)) ^ np.arange(BINS, dtype=np.uint64) * GOLDEN)
    return (salted & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def packed(sketch: np.ndarray) -> list[str]:
    """Two bins to a byte, as hexadecimal text."""
    pairs = sketch[:, 0::2] << 4 | sketch[:, 1::2]
    return [row.tobytes().hex() for row in pairs]


def unpacked(fingerprint: str) -> np.ndarray:
    pairs = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    return np.column_stack([pairs >> 4, pairs & 15]).ravel()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of sketches, row by row."""
    chance = 2.0**-BITS
    return np.clip(((a == b).mean(axis=-1) - chance) / (1 - chance), 0, 1)


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """All columns of ``docs`` and the fingerprint of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            made = packed(sketches(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.StringType())]))


def id_ranges(spark: SparkSession, ids: DataFrame) -> tuple[np.ndarray, dict[int, list[int]]]:
    """Cuts of the id axis, and for each range's first id the ranges that need its document as their lookahead.

    There are a few ranges to a shuffle partition, so both are bounded by the number of partitions.
    """
    count = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = ids.approxQuantile("order", [i / count for i in range(1, count)], 1 / (4 * count))
    cuts = np.unique(np.array(cuts, np.float64))

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, int] = {}
        for batch in batches:
            order = batch.column("order").to_numpy()
            place = np.searchsorted(cuts, order.astype(np.float64), "right")
            for r in np.unique(place).tolist():
                low = int(order[place == r].min())
                least[r] = min(low, least.get(r, low))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(least), pa.int64()), pa.array(list(least.values()), pa.int64())], names=["range", "first"]
        )

    found = ids.mapInArrow(firsts, "range bigint, first bigint").groupBy("range").agg(F.min("first").alias("first")).collect()
    filled = sorted((row.range, row["first"]) for row in found)
    wanted: dict[int, list[int]] = {}
    for i, (_, first) in enumerate(filled):
        wanted.setdefault(first, []).append(filled[i - 1][0])
    return cuts, wanted


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, whose last quarter is taken from the next document by ascending key.

    Ranges of keys are dealt out, each with a copy of the next range's first document, and read in order with the
    document that follows at hand; texts cross the shuffle once, compressed. The key must be a whole number.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 62)))
    base = docs.select(F.col(key).alias("key"), order.alias("order"), F.col(text).alias("text"))
    cuts, wanted = id_ranges(spark, base.select("order"))
    lookahead = np.array(sorted(wanted), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in pieces(batches, "text"):
            data, offsets = column_bytes(batch.column("text"))
            raw = data.tobytes()
            small = [press.compress(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            order = batch.column("order").to_numpy()
            place = np.searchsorted(cuts, order.astype(np.float64), "right")
            at = list(range(len(order)))
            range_, ahead = place.tolist(), [0] * len(order)
            for i in np.flatnonzero(np.isin(order, lookahead)).tolist():
                for r in wanted[int(order[i])]:
                    at.append(i)
                    range_.append(r)
                    ahead.append(1)
            tie = [int.from_bytes(hashlib.blake2b(x, digest_size=7).digest()) for x in small]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range_, pa.int64()),
                    pa.array(ahead, pa.int32()),
                    pa.array(order[at]),
                    pa.array([tie[i] for i in at], pa.int64()),
                    batch.column("key").take(pa.array(at)),
                    pa.array([small[i] for i in at], pa.binary()),
                ],
                names=["range", "ahead", "order", "tie", "key", "small"],
            )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        held: tuple | None = None  # the last row, whose next one is still to come
        for batch in pieces(batches, "small", 1 << 20):
            keys, ranges = batch.column("key").to_pylist(), batch.column("range").to_pylist()
            ahead = batch.column("ahead").to_pylist()
            texts = [expand.decompress(x).decode("utf-8", "surrogatepass") for x in batch.column("small").to_pylist()]
            made = sketches(pa.array(texts, pa.large_string()))
            if held:
                keys, ranges, ahead, texts = [held[0], *keys], [held[1], *ranges], [0, *ahead], [held[2], *texts]
                made = np.concatenate([held[3], made])
            at = [i for i in range(len(keys) - 1) if not ahead[i] and ranges[i] == ranges[i + 1]]
            edited = []
            for i in at:
                cut = len(texts[i]) // 4
                edited.append(texts[i][: len(texts[i]) - cut] + texts[i + 1][:cut])
            held = None if ahead[-1] else (keys[-1], ranges[-1], texts[-1], made[-1:])
            if not at:
                continue
            changed = sketches(pa.array(edited, pa.large_string()))
            own, following = made[at], made[[i + 1 for i in at]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[i] for i in at], batch.schema.field("key").type),
                    pa.array([len(texts[i]) for i in at], pa.int64()),
                    pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in edited], pa.string()),
                    pa.array(packed(own), pa.string()),
                    pa.array(packed(changed), pa.string()),
                    pa.array(likeness(own, changed)),
                    pa.array(likeness(own, following)),
                ],
                names=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return (
        base.mapInArrow(deal, f"range bigint, ahead int, order bigint, tie bigint, key {kind}, small binary")
        .repartition("range")
        .sortWithinPartitions("range", "ahead", "order", "tie")
        .mapInArrow(
            follow,
            f"key {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double",
        )
        .withColumnRenamed("key", key)
    )
