from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycast.operators import autoregression as ar

START = datetime(2024, 1, 1, 8)


def series_of(spark, values):
    rows = [(k, START + timedelta(minutes=i), int(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, total bigint")
    return df.withColumn("ts", df.ts.cast("timestamp_ntz"))


def by_numpy(values, lags, horizon):
    d = np.diff(np.asarray(values, float))
    x = np.array([[d[t - i] for i in range(1, lags + 1)] for t in range(lags, len(d))])
    phi = np.linalg.lstsq(x, d[lags:], rcond=None)[0]
    past, level, out = list(d), float(values[-1]), []
    for _ in range(horizon):
        past.append(sum(phi[i] * past[-1 - i] for i in range(lags)))
        level += past[-1]
        out.append(level)
    return phi, out


@pytest.mark.parametrize("lags", [1, 2, 5])
def test_fit_and_forecast_match_least_squares(spark, lags):
    rng = np.random.default_rng(2)
    values = {k: np.cumsum(rng.integers(0, 9, 200)) for k in ("a", "b")}
    models = ar.fit(series_of(spark, values), lags=lags)
    ahead = ar.forecast(models, 45).orderBy("key", "step").collect()
    for row in models.collect():
        phi, path = by_numpy(values[row.key], lags, 45)
        assert row.status == "ok" and row.n == 199 - lags and np.allclose(row.phi, phi)
        mine = [r for r in ahead if r.key == row.key]
        assert np.allclose([r.forecast for r in mine], path)
        assert [r.step for r in mine] == list(range(1, 46))
        assert mine[0].ts == START + timedelta(minutes=200) and mine[-1].ts == START + timedelta(minutes=244)


def test_degenerate_series_do_not_stop_the_job(spark):
    values = {"line": range(0, 300, 3), "point": [4], "few": [1, 2, 4, 4, 5, 9, 9, 12], "six": [1, 2, 3, 5, 8, 9]}
    models = {r.key: r for r in ar.fit(series_of(spark, values)).collect()}
    assert {k: r.status for k, r in models.items()} == {
        "line": "singular", "point": "insufficient", "few": "singular", "six": "insufficient"
    }
    assert np.allclose(models["line"].phi, [0.2] * 5)
    ahead = ar.forecast(ar.fit(series_of(spark, values)), 3).orderBy("key", "step").collect()
    assert {r.key for r in ahead} == {"line", "few"}
    assert np.allclose([r.forecast for r in ahead if r.key == "line"], [300, 303, 306])


def test_empty(spark):
    empty = series_of(spark, {"a": [1]}).limit(0)
    assert ar.forecast(ar.fit(empty)).count() == 0


def test_a_broken_series_fails_alone(spark):
    rows = [("good", i, float(i * i % 7)) for i in range(30)] + [("bad", i, float("nan") if i == 9 else float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "key string, minute int, total double")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("minute") * 60).cast("timestamp_ntz"))
    models = {r.key: r for r in ar.fit(df, lags=2).collect()}
    assert models["bad"].status == "failed" and models["bad"].phi is None and models["good"].status == "ok"
