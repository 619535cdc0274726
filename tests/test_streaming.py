import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tallycast import schemas, session
from tallycast.operators import lookup, outlook, refit, series, triggers
from tallycast.sources.readers import decode_json, stream_files
from tallycast.streaming import jobs
from tallycast.streaming.refit import LiveRefit
from tallycast.streaming.sinks import latest_rows, read_batches, save_batches
from tests.test_series import shuffled_events


@pytest.fixture
def feed(spark, make_events, tmp_path):
    """A folder of event files in arrival order, read one file per micro-batch."""
    folder = tmp_path / "feed"
    folder.mkdir()

    class Feed:
        schema = make_events([("a", "2024-01-01 08:00:00")]).schema

        def add(self, df, name):
            df.coalesce(1).write.parquet(str(tmp_path / f"w{name}"))
            part = next((tmp_path / f"w{name}").glob("part-*.parquet"))
            shutil.copy(part, folder / f"{name}.parquet")

        def stream(self):
            return stream_files(spark, str(folder), self.schema, "parquet", maxFilesPerTrigger="1")

    return Feed()


def files_of(feed, events, n, size):
    for i in range(n):
        feed.add(events.filter((F.col("arrival") >= i * size) & (F.col("arrival") < (i + 1) * size)), f"{i:03d}")


def test_totals_and_hours_equal_the_batch_answer(spark, feed, make_events, tmp_path):
    events = make_events(shuffled_events(0, n=400))
    files_of(feed, events, 4, 100)
    for name, stream, keys in (
        ("totals", jobs.running_totals(feed.stream()), ["key"]),
        ("hours", jobs.hourly_counts(feed.stream()), ["key", "hour_start"]),
    ):
        out = str(tmp_path / name)
        save_batches(stream, out, str(tmp_path / f"cp-{name}"), "update").awaitTermination()
        got = latest_rows(read_batches(spark, out, stream.schema), keys)
        if name == "totals":
            want = events.groupBy("key").agg(F.count("*").alias("running_total"))
        else:
            hour = F.window("ts", "1 hour").start.cast("timestamp_ntz")
            want = events.groupBy("key", hour.alias("hour_start")).agg(F.count("*").alias("n"))
        assert set(got.collect()) == set(want.collect())


def test_restart_repeats_and_loses_nothing(spark, feed, make_events, tmp_path):
    events = make_events(shuffled_events(0, n=300))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    dimension = spark.sql("SELECT * FROM VALUES ('a', 'A') AS t(key, label)")

    def look_up(batch):
        return lookup.join_dimension(batch, dimension, "key")

    feed.add(events.filter("arrival < 100"), "0")
    save_batches(feed.stream(), out, checkpoint, transform=look_up).awaitTermination()
    feed.add(events.filter("arrival >= 100"), "1")
    for _ in range(2):
        save_batches(feed.stream(), out, checkpoint, transform=look_up).awaitTermination()
    # The commit of the last batch is lost: it must be replayed into the same place.
    commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"))
    for lost in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        lost.replace(tmp_path / f"lost{lost.name}")
    save_batches(feed.stream(), out, checkpoint, transform=look_up).awaitTermination()
    got = read_batches(spark, out, look_up(events).schema).collect()
    assert len(got) == 300 and {r.arrival for r in got} == set(range(300))


@pytest.mark.parametrize("lateness", [0, 2000])
def test_live_refits_equal_the_batch_refits(spark, feed, make_events, tmp_path, lateness):
    rows = [(k, ts) for k, ts in shuffled_events(lateness, n=1500, seed=5) if k]
    events = make_events(rows)
    size = len(rows) // 3 + 1
    files_of(feed, events, 3, size)
    live = LiveRefit(str(tmp_path / "live"))
    live.start(feed.stream(), str(tmp_path / "cp")).awaitTermination()
    got = live.forecasts(spark).drop("batch_id")
    want = refit.refit_forecasts(events, triggers.trigger_points(events))
    mine = {(r.refit_arrival, r.key, r.step): (r.ts, round(r.forecast, 6)) for r in got.collect()}
    theirs = {(r.refit_arrival, r.key, r.step): (r.ts, round(r.forecast, 6)) for r in want.collect()}
    assert mine == theirs and len(mine) > 0
    totals = series.running_totals(events).count()
    kept = read_batches(spark, str(tmp_path / "live" / "parts"), spark.createDataFrame([], "key string, n bigint").schema)
    assert kept.agg(F.sum("n")).first()[0] == totals


def test_late_events_count_in_their_hour(spark, feed, make_events, tmp_path):
    rows = [("a", "2024-01-01 08:10:00"), ("a", "2024-01-01 12:40:00"), ("a", "2024-01-01 09:15:00"), ("a", "2024-01-01 08:20:00")]
    files_of(feed, make_events(rows), 4, 1)
    stream = jobs.hourly_counts(feed.stream())
    out = str(tmp_path / "out")
    save_batches(stream, out, str(tmp_path / "cp"), "update").awaitTermination()
    got = latest_rows(read_batches(spark, out, stream.schema), ["key", "hour_start"])
    assert {(r.hour_start.hour, r.n) for r in got.collect()} == {(8, 2), (9, 1), (12, 1)}


def test_every_refit_publishes_what_it_saw(spark, feed, make_events, tmp_path):
    rows = [(k, ts) for k, ts in shuffled_events(2000, n=900, seed=6) if k]
    events = make_events(rows)
    files_of(feed, events, 3, len(rows) // 3 + 1)
    live = LiveRefit(str(tmp_path / "live"))
    live.start(feed.stream(), str(tmp_path / "cp")).awaitTermination()
    decoded = decode_json(live.messages(spark).select("value"), schemas.MESSAGE)
    points = outlook.points_of(decoded).collect()
    steps = {(r.publication, r.candidate_id, r.time): r.votes for r in points if r.kind == "forecast"}
    ahead = live.forecasts(spark).collect()
    assert steps == {(r.refit_arrival, r.key, str(r.ts)): r.forecast for r in ahead} and steps
    shown = {(r.publication, r.candidate_id) for r in points}
    for trigger in triggers.trigger_points(events).collect():
        seen = series.minute_series(events.filter(F.col("arrival") <= trigger.arrival)).collect()
        want = {(r.key, str(r.ts), float(r.total)) for r in seen if (trigger.arrival, r.key) in shown}
        got = {(r.candidate_id, r.time, r.votes) for r in points if r.publication == trigger.arrival and r.kind == "history"}
        assert got == want
    newest = outlook.points_of(outlook.latest_publication(decoded))
    per_key = {r.candidate_id: r.n for r in newest.groupBy("candidate_id").agg(F.countDistinct("publication").alias("n")).collect()}
    assert set(per_key.values()) == {1}


def test_live_refits_survive_a_replay_and_leave_no_scratch(spark, feed, make_events, tmp_path):
    rows = [(k, ts) for k, ts in shuffled_events(0, n=600, seed=7) if k]
    files_of(feed, make_events(rows), 4, len(rows) // 4 + 1)
    shared = session.shared_folder(spark)
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    live = LiveRefit(str(tmp_path / "live"))
    live.start(feed.stream(), str(tmp_path / "cp")).awaitTermination()
    first = sorted(map(str, live.messages(spark).collect())), sorted(map(str, live.forecasts(spark).collect()))
    commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"))
    for lost in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        lost.replace(tmp_path / f"lost{lost.name}")
    live.start(feed.stream(), str(tmp_path / "cp")).awaitTermination()
    again = sorted(map(str, live.messages(spark).collect())), sorted(map(str, live.forecasts(spark).collect()))
    assert first == again
    assert set(os.listdir(shared)) - before == set()
    assert sorted(os.listdir(tmp_path / "live")) == ["forecasts", "mark", "messages", "parts", "totals"]


def test_messages_become_refits_and_broken_ones_are_kept(spark, make_events, tmp_path):
    rows = [(k, ts) for k, ts in shuffled_events(2000, n=900, seed=6) if k]
    body = lambda k, ts: json.dumps({"Voter_id": "v", "Candidate_id": k, "Vote_Time": ts})
    # Two broker partitions with their own offsets; broker times order the batch, offsets break ties.
    wire = [(body(k, ts), i % 2, i // 2, i // 4) for i, (k, ts) in enumerate(rows)]
    wire += [("broken", 0, 10**6, 30), (body("a", "not a time"), 1, 10**6, 200)]
    schema = "value string, partition int, offset bigint, timestamp bigint"
    folder = tmp_path / "wire"
    for n, (low, high) in enumerate([(0, 110), (110, 10**9)]):
        share = [w for w in wire if low <= w[3] < high]
        spark.createDataFrame(share, schema).coalesce(1).write.mode("append").parquet(str(folder))
    stream = stream_files(spark, str(folder), spark.createDataFrame([], schema).schema, "parquet", maxFilesPerTrigger="1")
    live = LiveRefit(str(tmp_path / "live"))
    live.start_messages(stream, str(tmp_path / "cp")).awaitTermination()

    order = sorted(range(len(rows)), key=lambda i: (i // 4, i % 2, i // 2))
    events = make_events([rows[i] for i in order])
    want = refit.refit_forecasts(events, triggers.trigger_points(events)).collect()
    got = live.forecasts(spark).collect()
    plain = lambda found: sorted((r.refit_ts, r.key, r.step, r.ts, round(r.forecast, 6)) for r in found)
    assert plain(got) == plain(want) and got
    rejected = read_batches(spark, str(tmp_path / "live" / "rejected"), spark.createDataFrame([], schema).schema).collect()
    assert sorted(r.value for r in rejected) == sorted(w[0] for w in wire[-2:])
    assert live.messages(spark).count() > 0
