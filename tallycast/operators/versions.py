"""Rows with the version of something that was in force then, such as the model a score should use."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.operators.prefix import BLOCK_BITS


def in_force(
    rows: DataFrame, versions: DataFrame, keys: Sequence[str], order: str, since: str, bits: int = BLOCK_BITS
) -> DataFrame:
    """Each row with the columns of its keys' latest version whose ``since`` isn't after the row's ``order``; null where there is none.

    ``order`` and ``since`` are bigints on one scale; of versions with one ``since`` the largest in its other columns holds. Null keys match each
    other; rows without an order have no version, and versions without a ``since`` never hold. The columns of ``versions`` but the keys are
    added, so they must not clash with those of ``rows``.

    Rows and versions are laid out together in blocks of 2**bits orders, and the last version before a block is carried into it by one extra row:
    one shuffle, no join, and no row meets more versions than its block holds. Choose ``bits`` so that a key's rows in a block are
    bounded; arrival numbers and minutes with a row each do that.
    """
    keys = list(keys)
    added = [c for c in versions.columns if c not in keys]
    known = F.struct(F.col(since).alias("_since"), *[F.col(c).alias(c) for c in added])
    dated = versions.filter(F.col(since).isNotNull()).groupBy(*keys, F.col(since).alias("_order")).agg(F.max(known).alias("_version"))
    block, outer = F.shiftright("_order", bits), F.shiftright("_block", bits)
    laid = (
        rows.withColumns({"_order": F.col(order), "_kind": F.lit(2)})
        .unionByName(dated.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
        .withColumn("_block", block)
    )
    latest = F.max("_version").alias("_version")  # the largest ``_since`` comes first
    blocks = laid.groupBy(*keys, "_block").agg(latest).withColumn("_outer", outer)
    outers = blocks.groupBy(*keys, "_outer").agg(latest)
    before = lambda *by: W.partitionBy(*keys, *by).rowsBetween(W.unboundedPreceding, -1)
    carry_outer = outers.withColumn("_version", F.last("_version", ignorenulls=True).over(before().orderBy("_outer")))
    carry = (
        blocks.unionByName(carry_outer, allowMissingColumns=True)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(before("_outer").orderBy(F.col("_block").asc_nulls_first())))
        .filter(F.col("_block").isNotNull())
        .select(*keys, "_block", "_version", F.lit(0).alias("_kind"))
    )
    upto_here = W.partitionBy(*keys, "_block").orderBy(
        F.col("_order").asc_nulls_first(), "_kind"
    ).rowsBetween(W.unboundedPreceding, W.currentRow)
    held = F.when(F.col("_order").isNotNull(), F.last("_version", ignorenulls=True).over(upto_here))
    return (
        laid.unionByName(carry, allowMissingColumns=True)
        .withColumn("_version", held)
        .filter("_kind = 2")
        .select(*rows.columns, *[F.col("_version")[c].alias(c) for c in added])
    )
