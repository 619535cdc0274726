import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallycast.operators import triggers
from tallycast.session import materialize
from tests.test_series import shuffled_events


def brute_triggers(rows):
    last, fired = None, []
    for i, (_, ts) in enumerate(rows):
        t = datetime.fromisoformat(ts)
        if t.minute == 0 and t.hour != 8 and t.hour != last:
            last = t.hour
            fired.append(i)
    return fired


def test_one_simulated_hour_fires_once_at_nine(make_events):
    start = datetime(2024, 1, 1, 8)
    events = make_events([("a", str(start + timedelta(seconds=3 * i))) for i in range(1201)])
    points = materialize(triggers.trigger_points(events))
    assert [(r.arrival, r.ts) for r in points.collect()] == [(1200, datetime(2024, 1, 1, 9))]
    assert [r.total for r in triggers.snapshot_totals(events, points).collect()] == [1201]


def test_an_hour_without_an_event_in_its_first_minute_is_skipped(make_events):
    rows = [("a", "2024-01-01 09:00:10"), ("a", "2024-01-01 10:05:00"), ("a", "2024-01-02 09:00:00"), ("a", "2024-01-02 10:00:00")]
    assert [r.arrival for r in triggers.trigger_points(make_events(rows)).orderBy("arrival").collect()] == [0, 3]


@pytest.mark.parametrize("bits", [2, 20])
def test_triggers_equal_the_record_loop_out_of_order(make_events, monkeypatch, bits):
    monkeypatch.setattr(triggers, "BLOCK_BITS", bits)
    rng = random.Random(3)
    hours = [rng.choice([8, 9, 9, 10, 11]) for _ in range(200)]
    rows = [("a", f"2024-01-01 {h:02d}:{rng.choice([0, 0, 1]):02d}:00") for h in hours]
    got = [r.arrival for r in triggers.trigger_points(make_events(rows)).orderBy("arrival").collect()]
    assert got == brute_triggers(rows)


@pytest.mark.parametrize("listed", [0, 100_000])
def test_snapshots_equal_the_record_loop(make_events, spark, listed):
    rows = shuffled_events(600, n=400)
    events = make_events(rows)
    fired = random.Random(1).sample(range(400), 25)
    points = materialize(events.filter(events.arrival.isin(fired)).select("arrival", "ts"))
    got = {(r.arrival, r.key): r.total for r in triggers.snapshot_totals(events, points, listed=listed).collect()}
    want = {(i, k): sum(1 for key, _ in rows[: i + 1] if key == k) for i in fired for k in ("a", "b", None)}
    assert got == want


def test_no_triggers(make_events):
    events = make_events([("a", "2024-01-01 08:00:00")])
    points = materialize(triggers.trigger_points(events))
    assert triggers.snapshot_totals(events, points).count() == 0


def test_a_crowded_trigger_list_is_merged_instead(make_events, spark):
    """One far-off arrival stretches the blocks so that most triggers share one."""
    rows = shuffled_events(0, n=200)
    events = make_events(rows)
    events = events.withColumn("arrival", F.when(events.arrival == 199, 10**12).otherwise(events.arrival))
    points = materialize(events.filter("arrival % 2 = 0 OR arrival > 1000").select("arrival", "ts"))
    got = {(r.arrival, r.key): r.total for r in triggers.snapshot_totals(events, points).collect()}
    at = {r.arrival: min(r.arrival, 199) for r in points.collect()}
    assert got == {(a, k): sum(1 for key, _ in rows[: i + 1] if key == k) for a, i in at.items() for k in ("a", "b", None)}
