import numpy as np
import pytest

from tallycast.operators import quantiles


def groups(rng):
    return {
        "normal": rng.normal(size=3000), "ties": rng.integers(0, 3, 2500).astype(float), "same": np.full(900, 7.0),
        "wide": 10.0 ** rng.uniform(-300, 300, 1200) * rng.choice([-1, 1], 1200), "one": np.array([5.0]), "two": np.array([1.0, 2.0]),
        None: rng.exponential(size=700), "edges": np.array([float("inf"), 1.0, 2.0, float("-inf"), 3.0] * 60),
    }


@pytest.mark.parametrize("few,accuracy", [(4096, 1000), (16, 20), (1, 1000)])
def test_quantiles_of_groups_of_any_size(spark, few, accuracy, monkeypatch):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    data = groups(np.random.default_rng(few))
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("one", None), ("two", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "key string, v double").repartition(6)
    fractions = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r.key: r for r in quantiles.exact_quantiles(df, ["key"], "v", fractions, few).collect()}
    assert set(got) == set(data)
    for key, values in data.items():
        assert got[key].n == len(values)
        ordered = np.sort(values)
        for f, mine in zip(fractions, got[key].quantiles):
            p = f * (len(ordered) - 1)
            low, high = ordered[int(np.floor(p))], ordered[int(np.ceil(p))]
            want = low if low == high else low + (high - low) * (p - np.floor(p))
            assert mine == pytest.approx(want, rel=1e-12, nan_ok=True), (key, f)


def test_boxes_and_outliers_of_raw_rows(spark):
    rng = np.random.default_rng(4)
    data = {"a": np.append(rng.normal(size=500), [9, -9, 12]), "b": np.arange(7.0)}
    df = spark.createDataFrame([(k, i, float(v)) for k, vs in data.items() for i, v in enumerate(vs)], "key string, id int, v double")
    boxes, outliers = quantiles.event_boxes(df, ["key"], "v", few=32)
    rows = {r.key: r for r in boxes.collect()}
    for key, values in data.items():
        q1, q2, q3 = np.percentile(values, [25, 50, 75])
        inside = (values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))
        r = rows[key]
        assert np.allclose([r.q1, r.median, r.q3], [q1, q2, q3])
        assert (r.n, r.whisker_low, r.whisker_high, r.n_outliers) == (len(values), values[inside].min(), values[inside].max(), (~inside).sum())
        assert {x.id for x in outliers.collect() if x.key == key} == set(np.flatnonzero(~inside).tolist())
    none, _ = quantiles.event_boxes(df.limit(0), ["key"], "v")
    assert none.count() == 0
