import os
from contextlib import nullcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycast.functions import stretches
from tallycast.operators import lagsums, refit, series, triggers
from tallycast.session import materialize
from tallycast.streaming import carried, manifest
from tallycast.streaming.carried import CarriedRefit
from tests.test_series import shuffled_events


def batches_of(events, n, size):
    return [materialize(events.filter((F.col("arrival") >= i * size) & (F.col("arrival") < (i + 1) * size))) for i in range(n)]


def plain(rows):
    return {
        (r.refit_arrival, r.key): (r.n, r.status, r.last_ts, r.last_value, r.tail, None if r.phi is None else np.round(r.phi, 8).tolist())
        for r in rows.collect()
    }


def wanted(events):
    points = materialize(triggers.trigger_points(events))
    parts = materialize(refit.history_parts(events, points))
    return plain(refit.refit_models(parts, points))


@pytest.mark.parametrize("lateness", [0, 4000])
def test_models_equal_the_refits_of_whole_histories(spark, make_events, tmp_path, lateness):
    rows = [(k, ts) for k, ts in shuffled_events(lateness, n=1500, seed=5) if k]
    events = make_events(rows)
    # Blocks of 16 minutes: most minutes are closed, and late events come hours behind their block.
    live = CarriedRefit(str(tmp_path / "live"), bits=4)
    read = []
    own = live._read
    live._read = lambda spark, schema, paths: read.append(list(paths)) or own(spark, schema, paths)
    for i, batch in enumerate(batches_of(events, 4, len(rows) // 4 + 1)):
        del read[:]
        live.process(batch, i)
    got, want = plain(live.models(spark)), wanted(events)
    assert got == want and len({arrival for arrival, _ in got}) >= 2
    state = manifest.newest(spark, live.folder)
    assert state["boundary"] > min(map(int, state["parts"])) and len(state["parts"]) > 5
    if not lateness:  # the last refit read no closed block
        blocks = {int(p.rsplit("=", 1)[1]) for paths in read for p in paths if "block=" in p}
        assert not any("/sums" in p for paths in read for p in paths)
        assert len(blocks) < len(state["parts"]) / 2
    totals = {r.key: r.so_far for r in live.totals(spark).collect()}
    assert totals == {r.key: r["count"] for r in events.groupBy("key").count().collect()}


def test_readers_see_whole_batches_only(spark, make_events, tmp_path, monkeypatch):
    rows = [(k, ts) for k, ts in shuffled_events(3000, n=900, seed=6) if k]
    events = make_events(rows)
    share = batches_of(events, 2, len(rows) // 2 + 1)
    live = CarriedRefit(str(tmp_path / "live"), bits=4, lags=2, horizon=3)
    live.process(share[0], 0)
    view = lambda: (sorted(map(str, live.forecasts(spark).collect())), sorted(map(str, live.totals(spark).collect())))
    first = view()
    own = live._write

    def failing(df, path, *partitions):
        if path.endswith("/models"):
            raise OSError("lost between two tables")
        return own(df, path, *partitions)

    monkeypatch.setattr(live, "_write", failing)
    with pytest.raises(OSError):
        live.process(share[1], 1)
    assert view() == first and manifest.committed(spark, live.folder) == [0]
    monkeypatch.setattr(live, "_write", own)
    live.process(share[1], 1)
    second = view()
    assert second != first
    live.process(share[1], 1)  # replayed after its commit: the same tables again, once
    assert view() == second
    data = tmp_path / "live" / "data"
    assert [len(os.listdir(data / name)) for name in sorted(os.listdir(data))] == [1, 1]
    points = materialize(triggers.trigger_points(events))
    want = refit.refit_forecasts(events, points, lags=2, horizon=3).collect()
    got = live.forecasts(spark).collect()
    key = lambda r: (r.refit_arrival, r.key, r.step, r.ts, round(r.forecast, 6))
    assert sorted(map(key, got)) == sorted(map(key, want)) and got


def test_exact_models_from_carried_state(spark, make_events, tmp_path):
    rows = [(k, ts) for k, ts in shuffled_events(0, n=700, seed=8) if k]
    events = make_events(rows)
    live = CarriedRefit(str(tmp_path / "live"), bits=4, lags=2, exact=True)
    for i, batch in enumerate(batches_of(events, 2, len(rows) // 2 + 1)):
        live.process(batch, i)
    got = live.models(spark).collect()
    at = max(r.refit_arrival for r in got)
    seen = series.minute_series(events.filter(F.col("arrival") <= at))
    want = {r.key: r for r in lagsums.fit_exact(seen, lags=2).collect()}
    mine = {r.key: r for r in got if r.refit_arrival == at}
    assert set(mine) == set(want)
    for key, row in mine.items():
        assert (row.status, row.n, row.last_ts) == (want[key].status, want[key].n, want[key].last_ts)
        assert row.phi is None or np.allclose(row.phi, want[key].phi, atol=1e-7)


def test_a_refit_works_out_what_changed(spark, make_events, tmp_path, monkeypatch):
    """A batch of many blocks and refits, with late events: a row per block and refit that saw news of it, not one for each with each."""
    rows = [(k, ts) for k, ts in shuffled_events(4000, n=1500, seed=5) if k]
    events = make_events(rows)
    made = {}

    def kept(df, label="table"):
        made[label] = materialize(df, label)
        return made[label]

    monkeypatch.setattr(carried, "materialize", kept)
    monkeypatch.setattr(carried, "scratch_scope", lambda spark: nullcontext())
    live = CarriedRefit(str(tmp_path / "live"), bits=4)
    live.process(events, 0)
    assert plain(live.models(spark)) == wanted(events)
    changes = made["pieces"].select("key", "interval").distinct().count()
    blocks, refits = made["pieces"].select("key").distinct().count(), made["triggers"].count()
    assert made["seen"].count() == changes < blocks * refits


@pytest.mark.parametrize("seed", range(4))
def test_versions_of_joined_blocks(seed):
    """Versions worked out by block and joined equal each version's own fold."""
    random = np.random.default_rng(seed)
    lags, width = int(random.integers(1, 6)), int(random.choice([1, 2, 7, 40]))
    changes = [(int(random.integers(0, 12)), int(random.integers(0, 60)), float(random.integers(0, 100))) for _ in range(50)]
    changes = sorted({(at, minute): (at, minute, total) for at, minute, total in changes}.values())
    blocks = []
    for block in range(60 // width + 1):
        own = [x for x in changes if x[1] // width == block]
        if own:
            blocks.append(stretches.versions_of(*(np.array(column) for column in zip(*own)), lags))
    at, found = stretches.fold_versions(blocks)
    assert at.tolist() == sorted({x[0] for x in changes})
    back = dict(zip(lagsums.SUMMARY_NAMES, lagsums.summary_arrays(found)))
    again = lagsums.stretches_of(back, lags)
    for i, interval in enumerate(at):
        last = {minute: total for seen, minute, total in changes if seen <= interval}
        want = stretches.fold([stretches.point(minute, last[minute], lags) for minute in sorted(last)])
        got = lagsums.stretch_of({name: column[i].as_py() for name, column in back.items()}, lags)
        for name in lagsums.SUMMARY_NAMES:
            assert np.array_equal(getattr(got, name), getattr(want, name)), name
            assert np.array_equal(getattr(again, name), getattr(found, name)), name
