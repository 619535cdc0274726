import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from tallycast.operators import series

START = datetime(2024, 1, 1, 8)


def brute_minutes(rows):
    """What appending totals in arrival order, resampling to minutes and filling forward gives."""
    history = {}
    for key, ts in rows:
        seen = history.setdefault(key, [])
        seen.append((pd.Timestamp(ts), len(seen) + 1))
    out = set()
    for key, seen in history.items():
        frame = pd.DataFrame(seen, columns=["ts", "total"]).set_index("ts").resample("min").last().ffill()
        out |= {(key, ts.to_pydatetime(), int(total)) for ts, total in frame["total"].items()}
    return out


def shuffled_events(lateness, n=300, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        late = rng.uniform(0, lateness) if rng.random() < 0.3 else 0
        rows.append((rng.choice(["a", "a", "a", "b", None]), str(START + timedelta(seconds=7 * i - int(late)))))
    return rows


def test_gaps_are_filled_forward(make_events):
    events = make_events([("a", "2024-01-01 08:00:05"), ("a", "2024-01-01 08:00:50"), ("a", "2024-01-01 08:03:10")])
    assert [r.total for r in series.minute_series(events).orderBy("ts").collect()] == [2, 2, 2, 3]


@pytest.mark.parametrize("lateness", [0, 20, 90, 1500])
def test_minute_series_equals_the_record_loop(make_events, lateness):
    rows = shuffled_events(lateness)
    got = {(r.key, r.ts, r.total) for r in series.minute_series(make_events(rows)).collect()}
    assert got == brute_minutes(rows)


def test_monotonic_check_sees_late_events(make_events):
    rows = [("a", "2024-01-01 08:00:05"), ("a", "2024-01-01 08:02:00"), ("a", "2024-01-01 08:01:00")]
    rows += [("b", "2024-01-01 08:00:05"), ("b", "2024-01-01 08:02:00")]
    got = {r.key: (r.points, r.decreases) for r in series.monotonic_check(series.minute_series(make_events(rows))).collect()}
    assert got == {"a": (3, True), "b": (3, False)}


def test_running_totals_count_every_event(make_events):
    rows = shuffled_events(600)
    got = series.running_totals(make_events(rows)).orderBy("arrival").collect()
    seen = {}
    for row, (key, _) in zip(got, rows):
        seen[key] = seen.get(key, 0) + 1
        assert (row.key, row.running_total) == (key, seen[key])


def test_last_seen(make_events):
    rows = [("a", "2024-01-01 08:05:00"), ("a", "2024-01-01 08:01:00")]
    assert series.last_seen(make_events(rows)).collect()[0].last_ts == datetime(2024, 1, 1, 8, 5)
