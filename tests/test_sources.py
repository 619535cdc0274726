from datetime import datetime

from pyspark.sql import functions as F

from tallycast import schemas
from tallycast.operators import cleaning
from tallycast.sources import readers, writers


def test_headerless_events_from_several_files(spark, tmp_path):
    (tmp_path / "2020.csv").write_text("Voter_id,Candidate_id,Vote_Time\nv1,a,2024-01-01 08:00:00\n")
    (tmp_path / "2000.csv").write_text("v2,b,2024-01-01 08:00:01\nv3,b,not a time\nv4,b\n")
    paths = [str(tmp_path / "2020.csv"), str(tmp_path / "2000.csv")]
    raw = readers.read_events_csv(spark, paths)
    assert {(r.entity, r.key) for r in cleaning.clean_events(raw).collect()} == {("v1", "a"), ("v2", "b")}
    assert cleaning.rejected_events(raw).count() == 3


def test_dimensions_are_read_as_text(spark, tmp_path):
    path = tmp_path / "keys.csv"
    path.write_text(",".join(schemas.KEY_DIMENSION.names) + "\nid1,male,Mr,A,B,Other,http://x\n")
    row = readers.read_table_csv(spark, str(path), schemas.KEY_DIMENSION).collect()[0]
    assert row["Candidate_id"] == "id1" and row["First Name"] == "A"


def test_key_in_the_path_survives_awkward_characters(spark, tmp_path):
    keys = ["plain", "with space", "a/b", "50%+1", "ü:x"]
    df = spark.createDataFrame([(k, "2024-01-01 08:00:00", 1.0) for k in keys], "key string, vote_time string, cumulative_votes double")
    writers.write_per_key_csv(df, str(tmp_path / "out"))
    back = readers.read_per_key_csv(spark, str(tmp_path / "out") + "/key=*", schemas.MINUTE_SERIES).collect()
    assert sorted(r.key for r in back) == sorted(keys)
    assert back[0].vote_time == datetime(2024, 1, 1, 8)
    named = tmp_path / "historical_data_k-1.csv"
    named.write_text("vote_time,cumulative_votes\n2024-01-01 08:00:00,5.0\n")
    read = readers.read_per_key_csv(spark, str(named), schemas.MINUTE_SERIES, r"historical_data_(.+)\.csv").collect()
    assert [(r.key, r.cumulative_votes) for r in read] == [("k-1", 5.0)]
    for name in ("100%", "a%41b", "x+y"):
        plain = tmp_path / f"plain_{name}.csv"
        plain.write_text("vote_time,cumulative_votes\n2024-01-01 08:00:00,5.0\n")
        read = readers.read_per_key_csv(spark, str(plain), schemas.MINUTE_SERIES, r"plain_(.+)\.csv").collect()
        assert [r.key for r in read] == [name]


def test_per_key_write_replaces_and_append_adds(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5)], "key string, predicted double")
    for _ in range(2):
        writers.write_per_key_csv(df, str(tmp_path / "replace"))
        writers.append_csv(df, str(tmp_path / "append"))
    assert spark.read.csv(str(tmp_path / "replace"), header=True).count() == 1
    assert spark.read.csv(str(tmp_path / "append")).count() == 2


def test_messages_round_trip_through_a_stream(spark, tmp_path):
    df = spark.createDataFrame(
        [("v1", "a", "2024-01-01 08:00:00", "http://p")], "Voter_id string, Candidate_id string, Vote_Time string, Voter_image string"
    )
    folder = str(tmp_path / "topic")
    writers.write_messages(writers.json_messages(df, "Candidate_id"), folder)
    spark.createDataFrame([("broken",), ("{}",)], "value string").write.mode("append").text(folder)
    stream = readers.live_events(readers.stream_files(spark, folder, spark.read.text(folder).schema, "text"))
    out = str(tmp_path / "out")
    stream.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 3
    assert [(r.entity, r.key, r.event_time, r.picture) for r in rows if r.entity] == [("v1", "a", "2024-01-01 08:00:00", "http://p")]


def test_models_of_one_run_are_replaced_alone(spark, tmp_path):
    def models(x):
        return spark.createDataFrame([("a", x)], "key string, intercept double")

    folder = str(tmp_path / "models")
    for run, value in (("r1", 1.0), ("r2", 2.0), ("r2", 3.0)):
        writers.save_models(models(value), folder, run)
    assert writers.load_models(spark, folder, "r2").collect()[0].intercept == 3.0
    both = writers.load_models(spark, folder).orderBy("run").collect()
    assert [(r.run, r.intercept) for r in both] == [("r1", 1.0), ("r2", 3.0)]


def test_kafka_is_only_a_format(spark):
    # The package is not installed here: the source must be the one thing that is missing.
    try:
        readers.stream_kafka(spark, "localhost:9092", "data_.*", pattern=True)
    except Exception as error:
        assert "kafka" in str(error).lower()


def test_events_as_messages_keep_their_count(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("x"))
    assert writers.json_messages(df).count() == 5


def test_topics_that_appear_later_are_read(spark, tmp_path):
    folder, out = str(tmp_path / "topics"), str(tmp_path / "out")
    send = lambda rows: writers.write_topics(spark.createDataFrame(rows, "key string, value string"), folder, F.concat(F.lit("data_"), F.col("key")))

    def drain():
        stream = readers.stream_topics(spark, folder)
        stream.writeStream.format("parquet").option("checkpointLocation", out + "-cp").trigger(availableNow=True).start(out).awaitTermination()
        return sorted((r.topic, r.value) for r in spark.read.parquet(out).collect())

    send([("a", "1"), ("b", "2")])
    assert drain() == [("data_a", "1"), ("data_b", "2")]
    send([("c", "3"), ("a", "4")])
    assert drain() == [("data_a", "1"), ("data_a", "4"), ("data_b", "2"), ("data_c", "3")]
    some = readers.stream_topics(spark, folder, ["data_c"])
    some.writeStream.format("memory").queryName("some_topics").trigger(availableNow=True).start().awaitTermination()
    assert [r.value for r in spark.table("some_topics").collect()] == ["3"]
