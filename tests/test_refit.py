import numpy as np
import pytest

from tallycast.operators import autoregression as ar
from tallycast.operators import refit, series
from tallycast.session import materialize
from tests.test_series import shuffled_events


@pytest.mark.parametrize("lateness", [0, 120, 3000])
def test_every_refit_equals_a_fit_of_what_had_arrived(make_events, lateness):
    rows = shuffled_events(lateness, n=500, seed=4)
    events = make_events(rows).filter("key is not null")
    fired = [3, 150, 151, 420, 490][1 if lateness else 0::2]
    points = materialize(events.filter(events.arrival.isin(fired)).select("arrival", "ts"))
    parts = materialize(refit.history_parts(events, points))
    got = {(r.refit_arrival, r.key): r for r in refit.refit_models(parts, points).collect()}
    arrivals = [r.arrival for r in points.collect()]
    assert len(arrivals) >= 1
    count = 0
    for at in arrivals:
        for want in ar.fit(series.minute_series(events.filter(events.arrival <= at))).collect():
            mine = got[at, want.key]
            count += 1
            assert (mine.n, mine.status, mine.last_ts, mine.last_value) == (want.n, want.status, want.last_ts, want.last_value)
            if want.phi is not None:
                assert np.allclose(mine.phi, want.phi) and mine.tail == want.tail
    assert count == len(got)


def test_no_refit(make_events):
    events = make_events([("a", "2024-01-01 08:00:00"), ("a", "2024-01-01 08:01:00")])
    assert refit.refit_forecasts(events, events.select("arrival", "ts").limit(0)).count() == 0
