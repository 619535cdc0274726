import pathlib

from tallycast.operators.buckets import Buckets, bucket_of


def test_only_asked_buckets_are_read(spark, tmp_path):
    dimension = spark.range(200).selectExpr("id AS entity", "concat('name', id) AS name")
    stored = Buckets.store(dimension, str(tmp_path / "dim"), "entity", 16)
    batch = spark.createDataFrame([(3, "x"), (3, "y"), (7, "z"), (None, "n"), (999, "u")], "entity bigint, tag string")
    wanted = {r.b for r in batch.filter("entity IS NOT NULL").select(bucket_of("entity", 16).alias("b")).collect()}
    assert 0 < len(wanted) < 16
    # Whatever else is opened fails.
    for folder in pathlib.Path(tmp_path / "dim").glob("_bucket=*"):
        if int(folder.name.split("=")[1]) not in wanted:
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"not parquet")
            for file in folder.glob(".*.crc"):
                file.unlink()
    got = sorted(stored.look_up(batch).select("entity", "tag", "name").collect(), key=str)
    want = [(3, "x", "name3"), (3, "y", "name3"), (7, "z", "name7"), (999, "u", None), (None, "n", None)]
    assert [tuple(r) for r in got] == sorted(want, key=lambda r: str(spark.createDataFrame([r], "entity bigint, tag string, name string").first()))
    renamed = stored.look_up(batch.withColumnRenamed("entity", "who"), "who", ["name"])
    assert renamed.columns == ["who", "tag", "name"] and renamed.filter("name = 'name3'").count() == 2
    assert stored.look_up(batch.limit(0)).count() == 0
