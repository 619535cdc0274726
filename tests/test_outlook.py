import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallycast.operators import outlook

START = datetime(2024, 1, 1, 8)


def forecasts(spark, rows):
    return spark.createDataFrame(rows, "key string, step int, forecast double").withColumn(
        "ts", F.lit("2024-01-01 09:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("step"), F.lit(0))
    )


def history(spark, key, n):
    rows = [(key, START + timedelta(minutes=i), i) for i in range(n)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, total bigint")
    return df.withColumn("ts", df.ts.cast("timestamp_ntz"))


def test_ties_go_to_the_first_in_rank_and_votes_are_truncated(spark):
    ahead = forecasts(spark, [("b", 1, 9.0), ("b", 2, 2.9), ("a", 2, 2.9), ("c", 2, 1.0)])
    assert outlook.projected_winner(ahead).collect()[0].asDict() == {"key": "a", "votes": 2}
    ranks = spark.sql("SELECT * FROM VALUES ('b', 1), ('a', 2) AS t(key, rank)")
    assert outlook.projected_winner(ahead, ranks).collect()[0].key == "b"
    assert outlook.projected_winner(ahead.limit(0)).count() == 0


def test_messages_hold_everything_in_bounded_parts(spark):
    past = history(spark, "a", 25).unionByName(history(spark, "quiet", 3))
    ahead = forecasts(spark, [("a", s, float(s)) for s in range(1, 4)])
    whole = outlook.publish_messages(past, ahead).collect()
    assert [(r.key, r.part, r.parts) for r in whole] == [("a", 0, 1)]  # no forecast, no message
    body = json.loads(whole[0].value)
    assert set(body) == {"candidate_id", "publication", "part", "parts", "forecast", "historical_data"}
    assert (body["candidate_id"], body["publication"], body["part"], body["parts"]) == ("a", 0, 0, 1)
    assert body["historical_data"][0] == {"vote_time": "2024-01-01 08:00:00", "cumulative_votes": 0.0}
    assert [p["votes"] for p in body["forecast"]] == [1.0, 2.0, 3.0] and body["forecast"][0]["time"] == "2024-01-01 09:01:00"
    split = sorted(outlook.publish_messages(past, ahead, points=10).collect(), key=lambda r: r.part)
    bodies = [json.loads(r.value) for r in split]
    assert [len(b["historical_data"]) for b in bodies] == [10, 10, 5] and [len(b["forecast"]) for b in bodies] == [0, 0, 3]
    assert sum((b["historical_data"] for b in bodies), []) == body["historical_data"]


def test_latest_message_replaces_earlier_ones(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "key string, offset int, value string")
    assert {r.key: r.value for r in outlook.latest_per_key(df).collect()} == {"a": "z", "b": None}
