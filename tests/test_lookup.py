import math

import pytest

from tallycast.operators import lookup

VECTORS = [("same", [1.0, 0.0]), ("ortho", [1.0, 0.0]), ("zero", [0.0, 0.0]), ("blind", [1.0, 0.0])]
LIVE = [
    ("same", [2.0, 0.0], 1.0, "match"),
    ("ortho", [0.0, 3.0], 0.0, "mismatch"),
    ("zero", [1.0, 0.0], None, "not_detected"),
    ("blind", None, None, "not_detected"),
    ("stranger", [1.0, 0.0], None, "no_reference"),
    (None, [1.0, 0.0], None, "no_reference"),
]


def test_verdicts(spark):
    dimension = spark.createDataFrame(VECTORS, "entity string, embedding array<float>")
    events = spark.createDataFrame([r[:2] for r in LIVE], "entity string, live array<float>")
    got = lookup.verify(events, lookup.reference_embeddings(dimension, "entity")).collect()
    assert {r.entity: (r.similarity, r.verdict) for r in got} == {r[0]: r[2:] for r in LIVE}


def test_threshold_is_inclusive(spark):
    dimension = spark.createDataFrame([("e", [1.0, 0.0])], "entity string, embedding array<float>")
    edge = [0.6, 0.8]
    events = spark.createDataFrame([("e", edge)], "entity string, live array<double>")
    refs = lookup.reference_embeddings(dimension, "entity")
    similarity = lookup.verify(events, refs).collect()[0].similarity
    assert math.isclose(similarity, 0.6)
    assert lookup.verify(events, refs, threshold=similarity).collect()[0].verdict == "match"


def test_first_record_of_an_entity_wins(spark):
    df = spark.createDataFrame([("e", 2, "late"), ("e", 1, "early")], "entity string, line int, picture string")
    assert lookup.first_per_entity(df, "entity", "line").collect()[0].picture == "early"


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_a_dominant_value_joins_like_any_other(spark, how):
    """Shuffled, with one value on most events, some unmatched and some null."""
    data = [(i, "hot" if i % 3 else f"e{i}") for i in range(600)] + [(1000 + i, None) for i in range(50)]
    events = spark.createDataFrame(data, "arrival bigint, entity string")
    dimension = spark.createDataFrame(
        [("hot", "H")] + [(f"e{i}", f"N{i}") for i in range(0, 600, 6)], "entity string, name string"
    )
    if how.startswith("left_"):
        dimension = dimension.select("entity")
    split = lookup.join_dimension(events, dimension, "entity", how, small=False)
    plain = events.join(dimension, "entity", how)
    key = lambda r: (r.arrival, *map(str, r))
    assert sorted(split.select(plain.columns).collect(), key=key) == sorted(plain.collect(), key=key)


def test_a_shuffled_lookup_reads_the_events_once(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.range(100).selectExpr("id AS arrival", "id % 7 AS entity").write.parquet(path)
    dimension = spark.range(7).selectExpr("id AS entity", "'n' AS name")
    joined = lookup.entity_lookup(spark.read.parquet(path), dimension, small=False)
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1 and joined.count() == 100


def test_size_is_measured_in_bytes(spark):
    wide = spark.createDataFrame([(1, "x" * 1000)], "entity int, name string")
    assert lookup.is_small(wide, 2000) and not lookup.is_small(wide, 900) and lookup.is_small(wide.limit(0), 0)


def test_embeddings_of_different_sizes_are_an_error_in_the_data(spark):
    dimension = spark.createDataFrame([("e", [1.0, 0.0])], "entity string, embedding array<float>")
    events = spark.createDataFrame([("e", [1.0, 0.0, 0.5])], "entity string, live array<float>")
    assert lookup.verify(events, lookup.reference_embeddings(dimension, "entity")).first().verdict == "not_comparable"
