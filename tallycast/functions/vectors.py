"""Similarity of two embeddings and the verdict drawn from it."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MATCH_THRESHOLD = 0.7  # fixed value: similarity from which two embeddings are the same face


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine similarity; null when a side is null or has no length, or the two differ in size.

    Pass the norms when the vectors come from a dimension that already holds them.
    """
    length = (norm(a) if norm_a is None else norm_a) * (norm(b) if norm_b is None else norm_b)
    return F.when(length > 0, dot(a, b) / length)


def comparable(a: Column, b: Column) -> Column:
    """False for two embeddings of different sizes, which is an error in the data."""
    return F.coalesce(F.size(a) == F.size(b), F.lit(True)) | a.isNull() | b.isNull()


def verdict(
    has_reference: Column, similarity: Column, threshold: float = MATCH_THRESHOLD, same_size: Column | None = None
) -> Column:
    """``no_reference``, ``not_comparable`` (sizes differ), ``not_detected``, ``match`` or ``mismatch``."""
    return (
        F.when(~has_reference, "no_reference")
        .when(~(F.lit(True) if same_size is None else same_size), "not_comparable")
        .when(similarity.isNull(), "not_detected")
        .when(similarity >= threshold, "match")
        .otherwise("mismatch")
    )
