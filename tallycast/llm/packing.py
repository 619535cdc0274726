"""Best-fit-decreasing packing of tokenised documents into sequences of bounded length.

Pieces of one length are interchangeable, so the packing is decided on the histogram of lengths, which has at most
``capacity`` entries whatever the corpus holds: lengths in descending order, each piece into the open sequence with the
tightest remaining capacity, found by a segment tree over capacities, else into a new one. The decision is a list of runs
(length, first rank, pieces, first sequence, offset). Spark numbers the pieces of each length (by task, then within
the task) and looks up the run that holds a piece's rank. No piece passes through the driver, and no group is collected.

Defined cases: a null or empty text is the end token alone; a text of more than ``capacity`` tokens is cut, and its full pieces
fill a sequence each; repeated rows and equal or null keys are packed each for itself; no rows give no pieces.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.llm.bpe import default_path, encoder
from tallycast.llm.text import column_bytes, pieces
from tallycast.session import materialize

CAPACITY = 4096
END_TOKEN = 1


class TightestTree:
    """A segment tree over capacities that finds the smallest one from a given size on with an open sequence."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)

    def mark(self, capacity: int, is_open: bool) -> None:
        node = capacity + self.leaves
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, size: int) -> int | None:
        node = size + self.leaves
        while not self.open[node]:
            while node & 1:  # a right child: nothing larger below its parent
                node //= 2
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:  # past the last leaf of the level
                return None
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first rank, pieces, first sequence, offset) that place ``counts[length]`` pieces of each length.

    The pieces of a run go to consecutive sequences, all at the run's offset.
    """
    tree = TightestTree(capacity)
    spaces: dict[int, deque[tuple[int, int]]] = {}
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def give(room: int, first: int, number: int) -> None:
        if room > 0:
            spaces.setdefault(room, deque()).append((first, number))
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                each = room // length
                first, number = sequences, max(left // each, 1)
                sequences += number
            else:
                first, number = spaces[room].popleft()
                if not spaces[room]:
                    tree.mark(room, False)
            each = room // length
            used, inside = (min(number, left // each), each) if left >= each else (1, left)
            for slot in range(inside):
                runs.append((length, rank, used, first, capacity - room + slot * length))
                rank += used
            left -= used * inside
            if used < number:
                give(room, first + used, number - used)
            give(room - inside * length, first, used)
    return np.array(runs, np.int64).reshape(-1, 5)


def token_pieces(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every document's pieces with their checksum, the task that made them and their rank among its pieces of that length."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        task = TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, np.int64)
        for batch in pieces(batches, "text", 1 << 20):
            ids, offsets = coder.encode(*column_bytes(batch.column("text")))
            sizes = np.diff(offsets) + 1
            begins = np.cumsum(sizes) - sizes
            stream = np.full(int(sizes.sum()), END_TOKEN, "<u4")
            stream[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes - 1)] = ids
            each = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), each)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
            start = piece * capacity
            length = np.minimum(sizes[row] - start, capacity)
            at = begins[row] + start
            crc = [zlib.crc32(stream[a:b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            sorted_length = length[order]
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.searchsorted(sorted_length, sorted_length) + met[sorted_length]
            met += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(row))]
                + [pa.array(piece, pa.int32())]
                + [pa.array(x, pa.int64()) for x in (start, length, crc)]
                + [pa.array(np.full(len(row), task), pa.int64()), pa.array(rank)],
                names=["key", "piece", "start", "length", "ids_crc32", "task", "rank"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(run, f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, task bigint, rank bigint")
        .withColumnRenamed("key", key)
    )


def pack(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and the ``offset`` there, gapless from 0.

    The pieces are written to the shared folder once, so their ranks stay as counted if executors are lost.
    """
    spark = docs.sparkSession
    made = materialize(token_pieces(docs, path, capacity, key, text), "pieces")
    by_task = made.groupBy("task", "length").agg(F.count("*").alias("pieces"))
    counts = {row.length: row.pieces for row in made.groupBy("length").agg(F.count("*").alias("pieces")).collect()}
    runs = plan(counts, capacity)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    shared = spark.sparkContext.broadcast(runs)  # bounded by the capacity: it doesn't grow with the pieces
    stride = max(counts.values(), default=0) + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        begins = runs[:, 0] * stride + runs[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = np.searchsorted(begins, length * stride + rank, "right") - 1
            names = [name for name in batch.schema.names if name != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in names]
                + [pa.array(runs[run, 3] + rank - runs[run, 1]), pa.array(runs[run, 4])],
                names=[*names, "sequence_id", "offset"],
            )

    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    bases = by_task.withColumn("base", F.coalesce(F.sum("pieces").over(before), F.lit(0))).drop("pieces")
    kind = docs.schema[key].dataType.simpleString()
    return (
        made.withColumnRenamed(key, "key")
        .join(bases, ["task", "length"])
        .select("key", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank"))
        .mapInArrow(
            place,
            f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
        )
        .withColumnRenamed("key", key)
    )
