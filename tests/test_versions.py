import random

import pytest

from tallycast.operators.versions import in_force


@pytest.mark.parametrize("bits", [1, 3, 20])
def test_each_row_has_the_latest_version_before_it(spark, bits):
    rng = random.Random(bits)
    some = lambda: rng.choice(["a", "a", "b", "c", None])
    rows = [(some(), rng.choice([None, rng.randint(-40, 90)]), i) for i in range(300)]
    dated = [(some(), rng.choice([None, rng.randint(-30, 80)]), rng.randint(0, 9)) for _ in range(25)]
    dated = [d for d in dated if d[0] != "c"]
    got = in_force(
        spark.createDataFrame(rows, "key string, at bigint, id int").repartition(3),
        spark.createDataFrame(dated, "key string, since bigint, model int").repartition(2), ["key"], "at", "since", bits,
    )
    assert got.columns == ["key", "at", "id", "since", "model"]

    def want(row):
        held = [(since, model) for key, since, model in dated if key == row[0] and since is not None and row[1] is not None and since <= row[1]]
        return max(held, default=(None, None))

    assert sorted(got.collect(), key=lambda r: r.id) == [(*row, *want(row)) for row in rows]


def test_no_versions(spark):
    rows = spark.createDataFrame([("a", 1)], "key string, at bigint")
    none = spark.createDataFrame([], "key string, since bigint, model int")
    assert in_force(rows, none, ["key"], "at", "since").collect() == [("a", 1, None, None)]
