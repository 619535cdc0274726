"""Exact quantiles of groups of any size, without bringing a group's values together.

A wanted rank is kept within an interval of values whose ranks are known by exact counts. Each round a sketch of the values in the interval
proposes two values close to the rank on either side, and a count tells exactly on which side of each the rank lies. So a round narrows an
interval to about 4 / ACCURACY of its rows. Once it holds FEW rows or less, these are sorted.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.operators.lookup import BROADCAST_BYTES, is_small
from tallycast.session import materialize

ACCURACY = 1000  # of the sketch: its ranks are off by this part of the rows at most
FEW = 4096
QUARTILES = (0.25, 0.5, 0.75)


def _beside(rows: DataFrame, table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows next to their group's row of ``table``, which is broadcast if it was measured to be small; null groups match."""
    renamed = table.withColumnsRenamed({c: f"_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    side = F.broadcast(renamed) if is_small(renamed, BROADCAST_BYTES) else renamed.hint("merge")
    return rows.join(side, same).drop(*[f"_{c}" for c in by])


def order_statistics(rows: DataFrame, by: Sequence[str], value: str, wanted: DataFrame, few: int = FEW) -> DataFrame:
    """The values at wanted ranks: ``(*by, rank, value)`` of ``wanted`` rows ``(*by, rank, n)``, ranks from 0 and below ``n`` of the group.

    Values are doubles without null and NaN. Runs Spark jobs, a few scans of the rows each round; the rounds grow with the logarithm of the
    largest group.
    """
    by = list(by)
    spark = rows.sparkSession
    values = rows.select(*by, F.col(value).cast("double").alias("_value"))
    # An open interval of values (null: no bound), the rows below it and in it.
    null = F.lit(None).cast("double")
    open_ = wanted.select(*by, "rank", null.alias("low"), null.alias("high"), F.lit(0).cast("bigint").alias("below"), F.col("n").alias("inside"))
    open_ = materialize(open_, "ranks")
    found = None
    names = ["rank", "low", "high", "below", "inside"]

    def met(table: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        """Values with each of their group's intervals that holds them."""
        each = table.groupBy(*by).agg(F.collect_list(F.struct(*names, *more)).alias("_ranks"))  # a few ranks per group
        within = lambda r: (r["low"].isNull() | (F.col("_value") > r["low"])) & (r["high"].isNull() | (F.col("_value") < r["high"]))
        return _beside(values, each, by).select(*by, "_value", F.explode(F.filter("_ranks", within)).alias("_r")).select(*by, "_value", "_r.*")

    while True:
        short = open_.filter(F.col("inside") <= few)
        sorted_ = met(short).groupBy(*by, *names).agg(F.sort_array(F.collect_list("_value")).alias("_sorted"))
        done = sorted_.select(*by, "rank", F.element_at("_sorted", (F.col("rank") - F.col("below") + 1).cast("int")).alias("value"))
        found = done if found is None else found.unionByName(done)
        long = open_.filter(F.col("inside") > few)
        if long.isEmpty():
            return found
        share = (F.col("rank") - F.col("below") + 0.5) / F.col("inside")
        sketch = met(long).groupBy(*by, *names).agg(
            F.percentile_approx("_value", [i / ACCURACY for i in range(ACCURACY + 1)], ACCURACY).alias("_marks")
        )
        at = lambda move: F.least(F.greatest(F.floor(share * ACCURACY).cast("int") + 1 + move, F.lit(1)), F.lit(ACCURACY + 1))
        split = materialize(
            sketch.select(*by, *names, F.element_at("_marks", at(-2)).alias("left"), F.element_at("_marks", at(3)).alias("right")), "marks"
        )
        v = F.col("_value")
        count = lambda which: F.count(F.when(which, 1))
        counted = met(split, ["left", "right"]).groupBy(*by, *names, "left", "right").agg(
            count(v < F.col("left")).alias("a"),
            count(v == F.col("left")).alias("b"),
            count((v > F.col("left")) & (v < F.col("right"))).alias("c"),
            count((v == F.col("right")) & (v > F.col("left"))).alias("d"),
        )
        place = F.col("rank") - F.col("below")
        a, b, c, d = (F.col(x) for x in "abcd")
        cases = [  # where the rank lies: (condition, value found, new interval)
            (place < a, None, ("low", "left", F.col("below"), a)),
            (place < a + b, "left", None),
            (place < a + b + c, None, ("left", "right", F.col("below") + a + b, c)),
            (place < a + b + c + d, "right", None),
        ]
        state = F.struct(null.alias("value"), F.col("right").alias("low"), F.col("high").alias("high"),
                         (F.col("below") + a + b + c + d).alias("below"), (F.col("inside") - a - b - c - d).alias("inside"))
        for condition, exact, interval in reversed(cases):
            if exact:
                made = F.struct(F.col(exact).alias("value"), null.alias("low"), null.alias("high"), F.lit(0).cast("bigint").alias("below"), F.lit(0).cast("bigint").alias("inside"))
            else:
                low, high, below, inside = interval
                made = F.struct(null.alias("value"), F.col(low).alias("low"), F.col(high).alias("high"), below.alias("below"), inside.alias("inside"))
            state = F.when(condition, made).otherwise(state)
        moved = materialize(counted.select(*by, "rank", state.alias("_state")).select(*by, "rank", "_state.*"), "ranks")
        found = found.unionByName(moved.filter("value IS NOT NULL").select(*by, "rank", "value"))
        open_ = moved.filter("value IS NULL").drop("value")


def exact_quantiles(
    rows: DataFrame, by: Sequence[str], value: str, fractions: Sequence[float] = QUARTILES, few: int = FEW
) -> DataFrame:
    """``(*by, n, quantiles)``: the group's count of values and, for each fraction, the linear interpolation between neighbouring values.

    Null and NaN values don't count; a group without others has no row.
    """
    by = list(by)
    rows = rows.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    sizes = materialize(rows.groupBy(*by).agg(F.count("*").alias("n")), "sizes")
    place = [F.lit(float(f)) * (F.col("n") - 1) for f in fractions]
    ranks = F.array_distinct(F.array(*[side(p).cast("bigint") for p in place for side in (F.floor, F.ceil)]))
    wanted = sizes.select(*by, "n", F.explode(ranks).alias("rank"))
    found = order_statistics(rows, by, value, wanted, few)
    both = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_at"))
    joined = _beside(sizes, both, by)

    def one(p):
        low, high = F.col("_at")[F.floor(p).cast("bigint")], F.col("_at")[F.ceil(p).cast("bigint")]
        return F.when(low == high, low).otherwise(low + (high - low) * (p - F.floor(p)))  # infinities have no difference

    return joined.select(*by, "n", F.array(*map(one, place)).alias("quantiles"))


def event_boxes(rows: DataFrame, by: Sequence[str], value: str, reach: float = 1.5, few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """Box-plot statistics per group of raw rows, and the rows outside the whiskers.

    ``(*by, n, q1, median, q3, whisker_low, whisker_high, n_outliers)`` and the rows themselves: neither needs a group in one place.
    """
    by = list(by)
    quartiles = exact_quantiles(rows, by, value, QUARTILES, few)
    q = F.col("quantiles")
    fences = materialize(
        quartiles.select(
            *by, F.col("n"), q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"),
            (q[0] - (q[2] - q[0]) * reach).alias("_low"), (q[2] + (q[2] - q[0]) * reach).alias("_high"),
        ),
        "fences",
    )
    v = F.col(value).cast("double")
    inside = (v >= F.col("_low")) & (v <= F.col("_high"))
    beside = _beside(rows.filter(F.col(value).isNotNull() & ~F.isnan(v)), fences, by)
    boxes = beside.groupBy(*by, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("n_outliers"),
    )
    return boxes, beside.filter(~inside).select(*rows.columns)
