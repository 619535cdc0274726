"""Exact top-k search by inner product with Fagin's threshold algorithm.

Vectors are dealt out in blocks of bounded size, and so are the queries; each block of queries meets each block of vectors. There every
dimension's vectors lie in a sorted list. For a query the lists are read from the end that its sign favours, all to the same depth;
each vector met is scored in full. What wasn't met scores no more than the query with the last value read from each list, so reading stops
as soon as the kth best score is above that bound. The best of all blocks are the answer.

Scores are integers: a component x counts as floor(SCALE * x), x as double. Vectors that are null or hold null or non-finite components
take no part, nor do rows without an id. Shorter vectors count as if zeros followed. A repeated row is a candidate to its twin, and each is a query.
No vectors or no queries give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SCALE = 256
BEST = 5
QUERY_STEP = 50
BLOCK = 2048
LEAST_BLOCK = 512
QUERY_BLOCK = 512


class SortedLists:
    """A block's vectors in a sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.lists = np.argsort(self.vectors, axis=0, kind="stable")

    def best(self, query: np.ndarray, count: int, own: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """Indices and scores of the best, ties to smaller ids, and the depth read. ``own`` is left out."""
        size = len(self.ids)
        used = np.flatnonzero(query)
        up = query[used] > 0
        met = np.zeros(size, bool)
        if own >= 0:
            met[own] = True
        top = np.zeros(0, np.int64)
        scores = np.zeros(0, self.vectors.dtype)
        depth, further = 0, min(16, size)
        while depth < size:
            if not len(used):  # every score is 0
                further = size
                new = np.flatnonzero(~met)
            else:
                low, high = self.lists[depth:further, used[~up]], self.lists[size - further : size - depth, used[up]]
                now = np.zeros(size, bool)
                now[low] = True
                now[high] = True
                new = np.flatnonzero(now & ~met)
            met[new] = True
            top, scores = np.append(top, new), np.append(scores, self.vectors[new] @ query)
            if len(top) > count:
                order = np.lexsort((top, -scores))[:count]  # indices follow the ids
                top, scores = top[order], scores[order]
            depth = further
            if len(top) >= count and len(used):
                last = np.where(up, self.lists[size - depth, used], self.lists[depth - 1, used])
                if scores.min() > (self.vectors[last, used] * query[used]).sum():
                    break
            further = min(2 * depth, size)
        order = np.lexsort((top, -scores))
        return top[order], scores[order], depth


def whole_numbers(vector: str) -> Column:
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(SCALE) * x.cast("double")))


def usable(vector: str) -> Column:
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return F.col(vector).isNotNull() & F.forall(vector, sound)


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows, short ones filled with zeros."""
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = (
        column.flatten().to_numpy()
    )
    return out


def top_products(
    vectors: DataFrame, count: int = BEST, step: int = QUERY_STEP, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """For each vector whose id is divisible by ``step`` the ``count`` others with the highest score: query_id, rank, vec_id, score.

    More columns: ``copy`` numbers repeated query ids.
    """
    spark = vectors.sparkSession
    sound = vectors.filter(usable(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), whole_numbers(vector).alias("values")
    )
    is_query = F.col("id") % step == 0
    sizes = sound.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-sizes.n // BLOCK), min(partitions, -(-sizes.n // LEAST_BLOCK)), 1)
    query_blocks = max(-(-sizes.q // QUERY_BLOCK), 1)
    dealt = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    copy = F.row_number().over(W.partitionBy("id").orderBy("values"))
    queries = (
        sound.filter(is_query)
        .withColumn("copy", copy)  # before they are dealt out
        .select("id", "values", "copy", dealt(query_blocks, 2).alias("query_block"), each(blocks).alias("block"))
    )
    candidates = sound.select("id", "values", dealt(blocks, 1).alias("block"), each(query_blocks).alias("query_block"))

    def meet(asked: pa.Table, given: pa.Table) -> pa.Table:
        names = ["query_id", "copy", "vec_id", "score"]
        found: list[tuple] = []
        if asked.num_rows and given.num_rows:
            sides = [(t.column("id").to_numpy(), t.column("values").combine_chunks()) for t in (asked, given)]
            width = max(int(x.value_lengths().to_numpy().max(initial=0)) for _, x in sides)
            (query_ids, queries), (ids, rows) = ((i, matrix(x, width)) for i, x in sides)
            exact = np.abs(queries).max(initial=0) * float(np.abs(rows).max(initial=0)) * width < 2**53
            kind = float if exact else np.int64  # whole numbers below 2**53 are exact as double
            lists = SortedLists(ids, rows.astype(kind))
            for number, again, query in zip(query_ids.tolist(), asked.column("copy").to_pylist(), queries.astype(kind), strict=True):
                twin = np.arange(*np.searchsorted(lists.ids, [number, number + 1]))
                twin = twin[(lists.vectors[twin] == query).all(axis=1)]
                top, scores, _ = lists.best(query, count, int(twin[0]) if len(twin) else -1)
                found += [(number, again, i, s) for i, s in zip(lists.ids[top].tolist(), scores.astype(np.int64).tolist(), strict=True)]
        columns = list(zip(*found, strict=True)) or [[]] * 4
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    met = (
        queries.groupBy("block", "query_block")
        .cogroup(candidates.groupBy("block", "query_block"))
        .applyInArrow(meet, "query_id bigint, copy int, vec_id bigint, score bigint")
    )
    rank = F.row_number().over(W.partitionBy("query_id", "copy").orderBy(F.col("score").desc(), "vec_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score", "copy")


SQL = f"""
WITH sound AS (
    SELECT CAST(vec_id AS BIGINT) AS id, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.id AS query_id, c.id AS vec_id,
        CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM sound q JOIN sound c ON q.id <> c.id WHERE q.id % {QUERY_STEP} = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score, CAST(1 AS INTEGER) AS copy FROM ranked WHERE rank <= {BEST}
"""
