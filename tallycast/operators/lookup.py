"""Dimension lookups and embedding checks."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.functions.vectors import MATCH_THRESHOLD, comparable, cosine, norm, verdict

BROADCAST_BYTES = 64 << 20  # largest dimension, as JSON text, that goes to every task


def first_per_entity(dimension: DataFrame, entity: str, order: str | None = None) -> DataFrame:
    """One row per entity: the first by ``order``, or the smallest row when no order is named."""
    rest = [c for c in dimension.columns if c != entity]
    record = F.struct(*rest)
    first = F.min_by(record, F.col(order)) if order else F.min(record)
    return dimension.groupBy(entity).agg(first.alias("_first")).select(entity, *[F.col("_first")[c].alias(c) for c in rest])


def is_small(dimension: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a dimension may go to every task: one pass over it measures its rows, not their number."""
    size = F.length(F.to_json(F.struct(*dimension.columns))).cast("bigint")
    return (dimension.agg(F.sum(size)).first()[0] or 0) <= limit


def join_dimension(
    events: DataFrame, dimension: DataFrame, on: str, how: str = "left", small: bool | None = None
) -> DataFrame:
    """Join events to a dimension with one row per ``on``, reading the events once.

    A ``small`` dimension (measured by ``is_small`` unless given; a stream decides once, at its start) goes to every
    task. Any other is joined by a shuffle of both sides, and adaptive execution splits the partitions of values
    that hold many events, nulls included, and repeats the one dimension row that each needs.
    """
    if is_small(dimension) if small is None else small:
        return events.join(F.broadcast(dimension), on, how)
    return events.join(dimension.hint("merge"), on, how)


def entity_lookup(
    events: DataFrame, dimension: DataFrame, entity: str = "entity", small: bool | None = None
) -> DataFrame:
    """Every event with its entity's columns, null when the entity is not registered."""
    return join_dimension(events, dimension, entity, "left", small)


def reference_embeddings(dimension: DataFrame, entity: str, embedding: str = "embedding") -> DataFrame:
    """Registered embeddings ready for ``verify``: the norm is taken once per entity, not per event."""
    return dimension.select(
        F.col(entity).alias("entity"),
        F.col(embedding).alias("reference"),
        norm(F.col(embedding)).alias("reference_norm"),
    )


def verify(
    events: DataFrame,
    references: DataFrame,
    live: str = "live",
    live_norm: Column | None = None,
    threshold: float = MATCH_THRESHOLD,
    small: bool | None = None,
) -> DataFrame:
    """Add ``similarity`` of the live and the registered embedding, and the ``verdict``.

    Verification never removes an event: counting is independent of it.
    """
    joined = entity_lookup(events, references, small=small)
    similarity = cosine(F.col(live), F.col("reference"), live_norm, F.col("reference_norm"))
    sizes = comparable(F.col(live), F.col("reference"))
    return (
        joined.withColumn("similarity", similarity)
        .withColumn("verdict", verdict(F.col("reference").isNotNull(), F.col("similarity"), threshold, sizes))
        .drop("reference", "reference_norm")
    )
