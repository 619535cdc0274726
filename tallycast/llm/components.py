"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.session import materialize


def _least(edges: DataFrame) -> DataFrame:
    """Each node's least neighbour; a node with many neighbours is aggregated before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) of every node that has an edge ``u``, ``v`` to another one.

    The number of rounds grows with the logarithm of the longest path; each round's edges are written to the shared folder.
    Self-loops and repeated edges are allowed; no edges give no rows.
    """
    edges = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).withColumn("least", F.least("least", "u"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        below = _least(large)
        small = (
            large.join(below, "u")
            .select(F.when(F.col("v") == F.col("least"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("least").alias("v"))
            .distinct()
        )
        edges = materialize(small, "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
