"""A dimension in hash buckets, so that a lookup reads the buckets it asks for and no others."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.operators.lookup import is_small, join_dimension

BUCKETS = 64


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


class Buckets:
    """A stored dimension with one row per key. What a micro-batch reads grows with the keys it asks for, not with the dimension."""

    def __init__(self, path: str, key: str, schema: str, buckets: int = BUCKETS):
        self.path, self.key, self.schema, self.buckets = path, key, schema, buckets

    @classmethod
    def store(cls, dimension: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> "Buckets":
        """Write the dimension once: a folder per bucket, its rows in the order of their key."""
        placed = dimension.withColumn("_bucket", bucket_of(key, buckets)).repartition("_bucket").sortWithinPartitions("_bucket", key)
        placed.write.partitionBy("_bucket").parquet(path)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dimension.schema.fields)
        return cls(path, key, schema, buckets)

    def asked(self, spark: SparkSession, keys: DataFrame, key: str) -> DataFrame:
        """The dimension's rows of the buckets that ``keys`` falls into: at most ``buckets`` numbers reach the driver, and other folders aren't opened."""
        wanted = [row.b for row in keys.filter(F.col(key).isNotNull()).select(bucket_of(key, self.buckets).alias("b")).distinct().collect()]
        stored = spark.read.schema(f"{self.schema}, _bucket int").parquet(self.path)
        return stored.filter(F.col("_bucket").isin(wanted) if wanted else F.lit(False)).drop("_bucket")

    def look_up(self, batch: DataFrame, key: str | None = None, columns: list[str] | None = None, small: bool | None = None) -> DataFrame:
        """Each row with its key's columns, null without one; ``batch`` is read twice, so pass a stored one. ``small`` as in ``join_dimension``."""
        key = key or self.key
        rows = self.asked(batch.sparkSession, batch, key)
        if columns is not None:
            rows = rows.select(self.key, *columns)
        rows = rows.withColumnRenamed(self.key, key)
        return join_dimension(batch, rows, key, "left", is_small(rows) if small is None else small)
