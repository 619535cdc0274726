import random

import pytest
from pyspark.sql import functions as F

from tallycast.operators.prefix import prefix_sums


@pytest.mark.parametrize("bits", [2, 5, 20])
def test_equals_a_plain_running_sum(spark, bits):
    rng = random.Random(bits)
    # Sparse and negative orders, a hot key, a null key.
    keys = ["hot"] * 6 + ["b", "c", None]
    orders = rng.sample(range(-500, 100_000), 400)
    data = [(rng.choice(keys), o, rng.randint(0, 9)) for o in orders]
    df = spark.createDataFrame(data, "key string, o bigint, v bigint")
    got = {(r.key, r.o): r.s for r in prefix_sums(df, ["key"], "o", F.col("v"), "s", bits).collect()}
    want, total = {}, {}
    for key, order, value in sorted(data, key=lambda r: r[1]):
        total[key] = total.get(key, 0) + value
        want[key, order] = total[key]
    assert got == want


def test_empty(spark):
    df = spark.createDataFrame([], "key string, o bigint")
    assert prefix_sums(df, ["key"], "o", F.lit(1), "s").count() == 0
