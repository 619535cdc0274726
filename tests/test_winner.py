import random

from tallycast.streaming import winner
from tallycast.streaming.winner import LiveWinner


def test_changes_equal_recomputing_after_each_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(winner, "FOLDERS", 3)
    rng = random.Random(3)
    ranks = {"a": 2, "b": 1, "c": 3, "d": 4}
    live = LiveWinner(str(tmp_path / "live"), spark.createDataFrame(list(ranks.items()), "key string, rank int"))
    read = []
    own = live._latest
    monkeypatch.setattr(live, "_latest", lambda spark, paths: read.append(len(paths)) or own(spark, paths))
    latest, leader, want, falls = {}, None, [], 0
    for batch_id in range(9):
        rows = [(rng.choice([*ranks, "stranger"]), i, rng.choice([None, float("nan"), *map(float, range(5, 9)), 7.9])) for i in range(rng.randint(0, 3))]
        if batch_id == 6:
            rows = [(leader[1], 0, 1.0)]
        before = leader and latest[leader[1]]
        for key, _, value in rows:
            if key in ranks and value is not None and value == value:
                latest[key] = value
        now = min(((-v, ranks[k], k) for k, v in latest.items()), default=None)
        falls += bool(leader and latest[leader[1]] < before)
        if now and (leader is None or now[2] != leader[1]):
            want.append((batch_id, now[2], int(-now[0]), leader and leader[1]))
        leader = now and (now[0], now[2])
        batch = spark.createDataFrame(rows, "key string, at int, forecast double")
        live.process(batch, batch_id)
        if batch_id == 6:
            live.process(batch, batch_id)  # replayed
            falls += 1
    assert [tuple(r) for r in live.changes(spark).orderBy("batch_id").collect()] == want and len(want) >= 3
    merges = len([n for n in read if n > 3])
    assert len(read) - merges <= falls  # other keys' forecasts are read only when the winner falls
