import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tallycast.functions import descent
from tallycast.operators import features, regression
from tests.test_regression import noisy

NAMES = [f"x{i}" for i in range(6)]
WEIGHTS = np.array([2.0, -1.0, 0.0, 0.5, 0.0, 3.0])


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    rows = []
    for key, shift in (("a", 0.0), ("b", 40.0), (None, 1e4)):
        x = rng.normal(size=(400, 6)) * [1, 5, 1, 0.1, 2, 1] + shift
        x[:, 4] += 0.8 * x[:, 0]
        y = x @ WEIGHTS + rng.normal(size=400) * 2
        rows += [(key, i % 5, *map(float, xs), float(v)) for i, (xs, v) in enumerate(zip(x, y))]
    rows += [("few", 0, *[1.0] * 6, 2.0), ("a", 1, *[1.0] * 5, None, 3.0), ("b", 2, *[1.0] * 6, float("nan"))]
    schema = "key string, fold int, " + ", ".join(f"{n} double" for n in NAMES) + ", y double"
    return spark.createDataFrame(rows, schema).repartition(4)


@pytest.mark.parametrize("reg,mix", [(0.01, 0.0), (0.1, 0.5), (0.5, 1.0), (1.0, 0.5), (1.0, 0.0)])
def test_six_features_match_the_spark_estimator(spark, table, reg, mix):
    models = {r.key: r for r in features.fit_features(table, NAMES, "y", fold=F.col("fold"), strengths=[reg], shares=[mix]).collect()}
    whole = table.na.drop(subset=[*NAMES, "y"]).filter("y <> double('nan')")
    for key in ("a", "b"):
        data = VectorAssembler(inputCols=NAMES, outputCol="features").transform(whole.filter(F.col("key") == key))
        theirs = LinearRegression(labelCol="y", regParam=reg, elasticNetParam=mix, tol=1e-12, maxIter=1000).fit(data)
        own = models[key]
        assert own.n == 400 and own.status == "ok" and own.gap <= descent.GAP
        assert np.allclose([*own.coefficients, own.intercept], [*theirs.coefficients, theirs.intercept], rtol=1e-3, atol=2e-3)
    assert models["few"].status == "insufficient" and models["few"].coefficients is None and models["few"].n == 1
    assert models[None].n == 400


def test_tuning_picks_the_best_held_out_point(spark, table):
    rows = {r.key: r for r in features.fit_features(table, NAMES, "y", fold=F.col("fold")).collect()}
    for key in ("a", "b"):
        scores = {}
        for reg in regression.GRID_STRENGTH:
            for mix in regression.GRID_L1_SHARE:
                one = features.fit_features(table.filter(F.col("key") == key), NAMES, "y", fold=F.col("fold"), strengths=[reg], shares=[mix]).first()
                scores[reg, mix] = one.mean_rmse
            if reg >= 0.1:
                break  # two strengths will do
        r = rows[key]
        assert r.mean_rmse <= min(scores.values()) + 1e-12
        if (r.reg_param, r.elastic_net_param) in scores:
            assert scores[r.reg_param, r.elastic_net_param] == pytest.approx(r.mean_rmse)


def test_two_features_equal_the_closed_form(spark):
    slots = noisy(spark)
    fold = ((F.col("hour") * 60 + F.col("minute")) % 5).cast("int")
    want = {r.key: r for r in regression.fit_best(slots, fold=fold).collect()}
    for r in features.fit_features(slots, ["hour", "minute"], "cumulative_votes", fold=fold).collect():
        w = want[r.key]
        assert (r.reg_param, r.elastic_net_param, r.n) == (w.reg_param, w.elastic_net_param, w.n)
        assert np.allclose([*r.coefficients, r.intercept, r.mean_rmse], [w.hour_coef, w.minute_coef, w.intercept, w.mean_rmse], rtol=1e-7)


def test_dependent_and_constant_features():
    n = np.array(50.0)
    x = np.random.default_rng(1).normal(size=(50, 2))
    data = np.column_stack([x[:, 0], 2 * x[:, 0], np.ones(50), x[:, 0] * 3 + x[:, 1]])
    centred = data - data.mean(0)
    coef, intercept, gap = descent.elastic_net(n, data.mean(0), centred.T @ centred, np.array([0.0, 0.1]), np.array([0.0, 1.0]))
    assert (gap <= 1e-8).all() and (coef[:, 2] == 0).all()
    assert np.allclose(data[:, :3] @ coef[0] + intercept[0], x[:, 0] * np.linalg.lstsq(centred[:, :1], centred[:, 3], rcond=None)[0] + intercept[0], atol=1e-6)
    flat = np.column_stack([x, np.full(50, 4.0)])
    centred = flat - flat.mean(0)
    coef, intercept, gap = descent.elastic_net(n, flat.mean(0), centred.T @ centred, 0.1, 0.5)
    assert (coef == 0).all() and intercept == 4.0 and gap == 0
