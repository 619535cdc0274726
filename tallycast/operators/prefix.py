"""Running sums that no hot key can pile into one task.

``order`` is a bigint, unique per key (an arrival number, a minute number). Its high bits
name a block, so a block holds at most 2**BLOCK_BITS rows whatever the key skew, and a
block of blocks at most 2**BLOCK_BITS blocks. The sum before each block is carried into it
by one extra row, which keeps null keys and needs no join.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_BITS = 20


def prefix_sums(
    rows: DataFrame, keys: list[str], order: str, value: Column, out: str, bits: int = BLOCK_BITS
) -> DataFrame:
    """Add ``out`` = sum of ``value`` over the key's rows up to and including this one.

    Sums are exact for integer values. One shuffle of the rows; the block tables are small.
    """
    rows = rows.withColumns({"_value": value, "_block": F.shiftright(F.col(order), bits)})
    blocks = (
        rows.groupBy(*keys, "_block")
        .agg(F.sum("_value").alias("_value"))
        .withColumn("_outer", F.shiftright("_block", bits))
    )
    outers = blocks.groupBy(*keys, "_outer").agg(F.sum("_value").alias("_value"))

    before_outer = W.partitionBy(*keys).orderBy("_outer").rowsBetween(W.unboundedPreceding, -1)
    carry_outer = outers.withColumn("_value", F.sum("_value").over(before_outer))

    before_block = (
        W.partitionBy(*keys, "_outer").orderBy(F.col("_block").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    )
    carry_block = (
        blocks.unionByName(carry_outer, allowMissingColumns=True)
        .withColumn("_value", F.sum("_value").over(before_block))
        .filter(F.col("_block").isNotNull())
        .drop("_outer")
    )

    upto_here = (
        W.partitionBy(*keys, "_block")
        .orderBy(F.col("_carried").desc(), F.col(order))
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        rows.withColumn("_carried", F.lit(False))
        .unionByName(carry_block.withColumn("_carried", F.lit(True)), allowMissingColumns=True)
        .withColumn(out, F.sum("_value").over(upto_here))
        .filter(~F.col("_carried"))
        .drop("_value", "_block", "_carried")
    )
