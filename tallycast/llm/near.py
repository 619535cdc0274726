"""Near-duplicate classes by ProbMinHash, banding and verification.

A text is the multiset of its five-word shingles. Each shingle throws points of a Poisson process, of a rate equal to its count, at
the registers of the sketch; a register keeps the shingle whose point came first. A shingle stops as soon as its next point comes later
than every register's first. Two texts' registers agree with the probability Jaccard similarity

    sum over common shingles d of 1 / sum over all shingles e of max(p(e) / p(d), q(e) / q(d)),

p and q being shares of the counts; without repeated shingles and with equally many it is the Jaccard similarity. Registers are cut into
bands; texts that agree in a band share a bucket.

Every text of a bucket is compared, on whole texts, with the bucket's hub, the text that shares most buckets. What is left apart in a bucket after
that is compared sketch by sketch in blocks of bounded size, and texts whose sketches allow the threshold are compared on whole texts there; only links
leave the task, no more than join the block's components. Classes are the connected components of the links. Equal texts are one node
throughout, so copies never make pairs.

Defined cases: a null text counts as empty; texts of fewer than five words have one shingle, so they are near only to equal words; the class id is the
least document id of the class (null if all are null); every row is returned, repeated ones too; no rows give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.components import components
from tallycast.llm.text import GOLDEN, SHINGLE_BASE, column_bytes, mix, pieces, shingles, spread, words
from tallycast.session import materialize

THRESHOLD = 0.8
WIDTH = 5
BANDS = 26
BAND_ROWS = 5
REGISTERS = BANDS * BAND_ROWS
DOUBT = 4.0  # standard deviations of a sketch's estimate
OFTEN = 1000
BLOCK = 512  # texts of a bucket that are compared with each other in one task
SKETCH_BYTES = 1 << 18


def weighted(column: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text in ascending order, their counts, and each text's first one."""
    hashes, first = shingles(words(*column_bytes(column)), width)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(hashes)))
    return hashes[at], counts, np.searchsorted(rows[at], np.arange(len(first)))


def sketch(hashes: np.ndarray, counts: np.ndarray, first: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The shingle whose point came first, for each text and register."""
    texts = len(first) - 1
    time = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, np.uint64)
    text = np.repeat(np.arange(texts), np.diff(first))
    shingle, rate, now = hashes, counts.astype(float), np.zeros(len(hashes))
    arrival = 0
    while len(text):
        draw = mix(shingle + np.uint64((arrival * 2 + 1) * int(GOLDEN) % 2**64))
        now = now - np.log(((draw >> np.uint64(11)).astype(float) + 1) * 2.0**-53) / rate
        last = time.reshape(texts, registers).max(axis=1)
        early = now < last[text]
        text, shingle, rate, now, draw = text[early], shingle[early], rate[early], now[early], draw[early]
        register = ((mix(draw + GOLDEN) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        at = text * registers + register
        np.minimum.at(time, at, now)
        won = time[at] == now
        winner[at[won]] = shingle[won]
        arrival += 1
    return winner.reshape(texts, registers)


def buckets(winners: np.ndarray) -> np.ndarray:
    """A hash for each band."""
    total = np.repeat(np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1), len(winners), axis=0) * GOLDEN
    for row in range(BAND_ROWS):
        total = total * SHINGLE_BASE + mix(winners[:, row::BAND_ROWS])
    return mix(total)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two weighted sets, given as ascending hashes and counts."""
    p, q = a[1] / a[1].sum(), b[1] / b[1].sum()
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    alone_p, alone_q = 1 - p[i].sum(), 1 - q[j].sum()
    ratio = p[i] / q[j]
    order = np.argsort(ratio, kind="stable")
    p, q, ratio = p[i][order], q[j][order], ratio[order]
    # From each ratio on p is the larger share, below it q.
    at = np.searchsorted(ratio, ratio)
    from_here = np.append(np.cumsum(p[::-1])[::-1], 0)[at] + max(alone_p, 0)
    until_here = np.insert(np.cumsum(q), 0, 0)[at] + max(alone_q, 0)
    return float(np.sum(1 / (from_here / p + until_here / q)))


def text_node(text: str) -> Column:
    """Equal texts are one node."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def sketched(docs: DataFrame) -> DataFrame:
    """Every different text's buckets and the low bytes of its registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SKETCH_BYTES):
            winners = sketch(*weighted(batch.column("text")))
            low = (mix(winners + GOLDEN) & np.uint64(255)).astype(np.uint8)
            each = pa.array(buckets(winners).view(np.int64).ravel())
            ends = pa.array(np.arange(len(winners) + 1, dtype=np.int32) * BANDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(ends, each), pa.array([x.tobytes() for x in low], pa.binary())],
                names=["node", "buckets", "low"],
            )

    return docs.mapInArrow(run, "node binary, buckets array<bigint>, low binary").dropDuplicates(["node"])


def compressed(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in pieces(batches, "text"):
            data, offsets = column_bytes(batch.column("text"))
            raw = data.tobytes()
            small = [press.compress(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(small, pa.binary())], names=["node", "small"])

    return docs.mapInArrow(run, "node binary, small binary")


def expanded(column: pa.Array) -> pa.Array:
    expand = zstandard.ZstdDecompressor()
    return pa.array([expand.decompress(x) for x in column.to_pylist()], pa.large_binary())


def near_pairs(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose whole texts are at least ``threshold`` similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "small_u", 1 << 18):
            node, at = np.unique(np.array(batch.column("v").to_pylist(), object), return_inverse=True)
            _, some = np.unique(at, return_index=True)
            us, vs = (weighted(expanded(x)) for x in (batch.column("small_u"), batch.column("small_v").take(pa.array(some))))
            take = lambda x, i: (x[0][x[2][i] : x[2][i + 1]], x[1][x[2][i] : x[2][i + 1]])
            near = [similarity(take(us, i), take(vs, j)) >= threshold for i, j in enumerate(at.tolist())]
            yield batch.select(["u", "v"]).filter(pa.array(near, pa.bool_()))

    return (
        pairs.join(texts.withColumnsRenamed({"node": "u", "small": "small_u"}), "u")
        .join(texts.withColumnsRenamed({"node": "v", "small": "small_v"}), "v")
        .select("u", "v", "small_u", "small_v")
        .mapInArrow(run, "u binary, v binary")
    )


def similarities(sets: tuple[np.ndarray, np.ndarray, np.ndarray], one: int, others: np.ndarray) -> np.ndarray:
    """The similarity of one weighted set to others, all rows of ``sets`` (hashes, counts, first)."""
    hashes, counts, first = sets
    sizes = np.diff(first)
    own = hashes[first[one] : first[one + 1]]
    at = spread(first[others], sizes[others])
    place = np.minimum(np.searchsorted(own, hashes[at]), len(own) - 1)
    common = np.add.reduceat((own[place] == hashes[at]).astype(np.int64), np.cumsum(sizes[others]) - sizes[others])
    out = common / (sizes[others] + len(own) - common)  # the same without repeated shingles
    single = np.maximum.reduceat(counts, first[:-1]) == 1
    cut = lambda i: (hashes[first[i] : first[i + 1]], counts[first[i] : first[i + 1]])
    for i in np.flatnonzero(~(single[others] & single[one])).tolist():
        out[i] = similarity(cut(one), cut(others[i]))
    return out


def links_apart(members: DataFrame, threshold: float) -> DataFrame:
    """Links between a bucket's texts in different components; ``members`` has columns bucket, band, node, component, is_hub, low, buckets, small.

    A bucket is cut into blocks of about BLOCK texts and every two blocks meet in one task, so no task holds more than two. Two texts
    are compared in the first bucket they share.
    """
    chance = 1 / 256
    doubt = DOUBT * np.sqrt(threshold * (1 - threshold) / REGISTERS)
    enough = (threshold - doubt) * (1 - chance) + chance
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    meetings = (
        members.withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("node", F.lit(1)), blocks).cast("int")})
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"first": F.least("own", "other"), "second": F.greatest("own", "other")})
        .select("bucket", "first", "second", "own", "band", "node", "component", "is_hub", "low", "buckets", "small")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _sorted_groups(batches, ["bucket", "first", "second"]):
            low = np.frombuffer(b"".join(rows["low"]), np.uint8).reshape(len(rows["low"]), REGISTERS)
            bucket = np.array(rows["buckets"], np.int64)
            component = np.unique(np.array(rows["component"], object), return_inverse=True)[1]
            hub, own, band = np.array(rows["is_hub"]), np.array(rows["own"]), rows["band"][0]
            same_block = rows["first"][0] == rows["second"][0]
            sets = None
            us, vs = [], []
            for i in range(len(low) - 1):
                rest = np.arange(i + 1, len(low))
                rest = rest[(component[rest] != component[i]) & ~hub[rest] & (same_block | (own[rest] != own[i]))]
                if hub[i] or not len(rest):
                    continue
                before = (bucket[rest, :band] == bucket[i, :band]).any(axis=1)
                rest = rest[((low[rest] == low[i]).mean(axis=1) >= enough) & ~before]
                if not len(rest):
                    continue
                sets = sets or weighted(expanded(pa.array(rows["small"], pa.binary())))
                for j in rest[similarities(sets, i, rest) >= threshold].tolist():
                    if component[i] != component[j]:
                        us.append(rows["node"][i])
                        vs.append(rows["node"][j])
                        component[component == component[j]] = component[i]
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])

    return (
        meetings.repartition("bucket", "first", "second")
        .sortWithinPartitions("bucket", "first", "second", "node")
        .mapInArrow(run, "u binary, v binary")
    )


def _sorted_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Columns of each run of rows with equal values in a sorted stream."""
    held: dict[str, list] | None = None
    value: tuple = ()
    for batch in batches:
        columns = batch.to_pydict()
        keys = list(zip(*(columns[name] for name in by), strict=True))
        at = 0
        while at < len(keys):
            end = at
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            part = {name: x[at:end] for name, x in columns.items()}
            if held is not None and value == keys[at]:
                for name, x in part.items():
                    held[name].extend(x)
            else:
                if held is not None:
                    yield value, held
                held, value = part, keys[at]
            at = end
    if held is not None:
        yield value, held


def node_components(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The component of each text that is near to another; ``docs`` has columns node and text."""
    made = materialize(sketched(docs), "sketches")
    entries = made.select(F.posexplode("buckets").alias("band", "bucket"), "node")
    shared = entries.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = materialize(entries.join(shared, "bucket"), "buckets")
    reach = members.groupBy("node").agg(F.sum("size").alias("reach"))
    hubs = members.join(reach, "node").groupBy("bucket").agg(F.max(F.struct("reach", "node")).node.alias("hub"))
    hubs = materialize(hubs, "hubs")
    to_hub = members.join(hubs, "bucket").filter("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct()
    texts = materialize(
        compressed(docs.select("node", "text")).join(reach.select("node"), "node", "left_semi").dropDuplicates(["node"]), "near-texts"
    )
    first = components(near_pairs(to_hub, texts, threshold))
    placed = materialize(
        members.join(first, "node", "left").withColumn("component", F.coalesce("component", "node")), "near-placed"
    )
    # A bucket of two is settled by its hub.
    open_ = (
        placed.filter("size > 2")
        .groupBy("bucket")
        .agg(F.min("component").alias("low_component"), F.max("component").alias("high_component"))
        .filter("low_component <> high_component")
        .select("bucket")
    )
    left = (
        placed.join(open_, "bucket")
        .join(hubs, "bucket")
        .withColumn("is_hub", F.col("node") == F.col("hub"))
        .drop("hub")
        .join(made.select("node", "low", "buckets"), "node")
        .join(texts, "node")
    )
    rest = links_apart(left, threshold)
    return components(first.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(rest))


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Every document's key, its text's node, class_id (the class's least key), class_size, and ``kept``: whether it stays."""
    rows = docs.select(F.col(key).alias("key"), text_node(text).alias("node"), F.col(text).alias("text"))
    found = node_components(rows.select("node", "text"), threshold)
    nodes = rows.groupBy("node").agg(
        F.count("*").alias("copies"), F.min(F.struct(F.col("key").isNull(), F.col("key"))).alias("least")
    )
    nodes = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = nodes.groupBy("component").agg(
        F.sum("copies").alias("class_size"), F.min(F.struct(F.col("least.*"), F.col("node").alias("node"))).alias("kept")
    )
    named = nodes.join(classes, "component").select(
        "node", "copies", F.struct(F.col("kept.key").alias("class_id"), "class_size", F.col("kept.node").alias("node")).alias("found")
    )
    named = materialize(named, "near-named")
    total = named.agg(F.sum("copies")).first()[0] or 0
    # Fewer than OFTEN texts make up more than 1 / OFTEN of the rows each: they are broadcast, and their rows dealt out evenly.
    often = named.filter(F.col("copies") * OFTEN > total).select("node", F.col("found").alias("often"))
    placed = rows.drop("text").join(F.broadcast(often), "node", "left")
    placed = placed.withColumn("asked", F.when(F.col("often").isNull(), F.col("node")).otherwise(F.unhex(F.sha1(F.col("key").cast("string")))))
    rest = named.select(F.col("node").alias("asked"), "found")
    return (
        placed.join(rest, "asked", "left")
        .withColumn("found", F.coalesce("often", "found"))
        .select(
            F.col("key").alias(key),
            "found.class_id",
            "found.class_size",
            (F.col("key").eqNullSafe(F.col("found.class_id")) & (F.col("node") == F.col("found.node"))).alias("kept"),
            "node",
        )
    )
