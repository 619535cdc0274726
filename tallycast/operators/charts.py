"""The tables behind the usual charts of slot values."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def heatmap_pivot(slots: DataFrame, value: str, key: str | None = None) -> DataFrame:
    """Hour by minute matrix of sums, columns ``m0`` to ``m59``; an empty cell is null."""
    by = [key, "hour"] if key else ["hour"]
    pivoted = slots.groupBy(*by).pivot("minute", list(range(60))).agg(F.sum(value))
    return pivoted.select(*by, *[F.col(f"`{m}`").alias(f"m{m}") for m in range(60)])


def box_stats(slots: DataFrame, value: str, key: str = "key", reach: float = 1.5) -> DataFrame:
    """Box-plot statistics per key for each hour 0 to 23, hours without values included.

    Quartiles interpolate linearly, whiskers end at the furthest value within ``reach``
    inter-quartile ranges, the rest are outliers. A slot table has at most 60 values per key
    and hour, so a box and its outlier list are bounded.
    """
    v = F.col(value).cast("double")
    boxes = slots.groupBy(key, "hour").agg(
        F.percentile(v, [0.25, 0.5, 0.75]).alias("_q"),
        F.sort_array(F.collect_list(v)).alias("_values"),
    )
    q1, q3 = F.col("_q")[0], F.col("_q")[2]
    low, high = q1 - (q3 - q1) * reach, q3 + (q3 - q1) * reach
    boxes = boxes.select(
        key, "hour",
        F.size("_values").cast("bigint").alias("n"),
        q1.alias("q1"), F.col("_q")[1].alias("median"), q3.alias("q3"),
        F.filter("_values", lambda x: (x >= low) & (x <= high)).alias("_inside"),
        F.filter("_values", lambda x: (x < low) | (x > high)).alias("outliers"),
    ).select(
        key, "hour", "n", "q1", "median", "q3",
        F.array_min("_inside").alias("whisker_low"),
        F.array_max("_inside").alias("whisker_high"),
        "outliers",
    )
    hours = F.explode(F.sequence(F.lit(0), F.lit(23)))
    empty = slots.select(key).distinct().select(key, hours.alias("hour"), F.lit(0).cast("bigint").alias("n"))
    together = empty.unionByName(boxes, allowMissingColumns=True)
    return together.groupBy(key, "hour").agg(
        *[F.max(c).alias(c) for c in ("n", "q1", "median", "q3", "whisker_low", "whisker_high")],
        F.coalesce(F.max("outliers"), F.array().cast("array<double>")).alias("outliers"),
    )


def hour_histogram(slots: DataFrame, bins: int = 24, weight: str | None = None) -> DataFrame:
    """Equal-width bins between the smallest and the largest hour, the last one closed.

    Counts slots; with ``weight`` sums that column instead. Empty bins are listed with 0. At most
    24 distinct hours reach the final step.
    """
    amount = F.sum(weight) if weight else F.count("*")
    hours = slots.groupBy("hour").agg(amount.cast("bigint").alias("n"))
    lo, hi = F.min("hour").cast("double"), F.max("hour").cast("double")
    # One single hour spans half an hour to either side.
    left = F.when(lo == hi, lo - 0.5).otherwise(lo).alias("left")
    right = F.when(lo == hi, hi + 0.5).otherwise(hi).alias("right")
    ends = hours.agg(left, right)

    span = hours.withColumn("_span", ends.select(F.struct("left", "right")).scalar())
    hour = F.col("hour").cast("double")
    number = F.width_bucket(hour, F.col("_span")["left"], F.col("_span")["right"], F.lit(bins))
    counted = span.select(F.least(number, F.lit(bins)).cast("int").alias("bin"), "n")
    empty = ends.select(
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"),
        F.lit(0).cast("bigint").alias("n"),
        "left",
        ((F.col("right") - F.col("left")) / bins).alias("width"),
    )
    return (
        empty.unionByName(counted, allowMissingColumns=True)
        .groupBy("bin")
        .agg(
            (F.max("left") + (F.col("bin") - 1) * F.max("width")).alias("bin_start"),
            F.sum("n").alias("n"),
        )
    )
