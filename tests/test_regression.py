import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tallycast.operators import regression

# Coefficients of the published predictions (hour, minute, intercept).
GOLDEN = {
    "4714f68f": (334.91494079, 5.61756653, -2656.67201254),
    "940da220": (331.42554056, 5.44598706, -2652.95189444),
    "bd7098b3": (338.73353474, 5.63034236, -2724.83471509),
}


def slots_of(spark, rows):
    return spark.createDataFrame(rows, "key string, hour int, minute int, cumulative_votes double")


def noisy(spark, keys=("a", "b")):
    rng = np.random.default_rng(1)
    rows = []
    for i, key in enumerate(keys):
        total = 0
        for h in range(8, 17):
            for m in range(60):
                total += int(rng.integers(0, 12 + 5 * i))
                if rng.random() < 0.9:
                    rows.append((key, h, m, float(total)))
    return slots_of(spark, rows)


def test_published_predictions_give_their_coefficients_and_scores(spark):
    rows = [(k, h, m, a * h + b * m + c) for k, (a, b, c) in GOLDEN.items() for h in range(8, 17) for m in range(60)]
    slots = slots_of(spark, rows)
    models = regression.fit_ols(slots)
    for r in models.collect():
        assert np.allclose((r.hour_coef, r.minute_coef, r.intercept), GOLDEN[r.key], atol=1e-7) and r.n == 540
    scored = {(r.key, r.hour, r.minute): r.scaled_votes for r in regression.score_slots(models, slots).collect()}
    assert len(scored) == 3 * 540
    assert scored["940da220", 15, 26] == pytest.approx(2460.0268776042435, abs=1e-5)


def test_all_grid_points_match_the_spark_estimator(spark):
    slots = noisy(spark, ("a",))
    ours = {(r.reg_param, r.elastic_net_param): r for r in regression.cv_grid(slots).collect()}
    assembled = VectorAssembler(inputCols=["hour", "minute"], outputCol="features").transform(slots)
    for reg, mix in ((0.01, 0.0), (1.0, 0.5), (0.5, 1.0)):
        theirs = LinearRegression(labelCol="cumulative_votes", regParam=reg, elasticNetParam=mix).fit(assembled)
        r = ours[reg, mix]
        assert np.allclose([r.hour_coef, r.minute_coef, r.intercept], [*theirs.coefficients, theirs.intercept], rtol=1e-5)


def test_cross_validation_matches_the_spark_validator(spark):
    slots = noisy(spark, ("a",)).withColumn("fold", ((F.col("hour") * 60 + F.col("minute")) % 5).cast("int"))
    grid = regression.cv_grid(slots, fold=F.col("fold")).orderBy("grid").collect()
    lr = LinearRegression(labelCol="cumulative_votes")
    points = (
        ParamGridBuilder()
        .addGrid(lr.regParam, list(regression.GRID_STRENGTH))
        .addGrid(lr.elasticNetParam, list(regression.GRID_L1_SHARE))
        .build()
    )
    assembled = VectorAssembler(inputCols=["hour", "minute"], outputCol="features").transform(slots)
    evaluator = RegressionEvaluator(labelCol="cumulative_votes", metricName="rmse")
    model = CrossValidator(
        estimator=lr, estimatorParamMaps=points, evaluator=evaluator, numFolds=5, foldCol="fold", parallelism=4
    ).fit(assembled)
    by_point = {(p[lr.regParam], p[lr.elasticNetParam]): m for p, m in zip(points, model.avgMetrics)}
    for r in grid:
        assert r.mean_rmse == pytest.approx(by_point[r.reg_param, r.elastic_net_param], abs=1e-5)


def test_best_is_the_smallest_error_and_folds_repeat(spark):
    slots = noisy(spark)
    first = regression.fit_best(slots).orderBy("key").collect()
    grid = regression.cv_grid(slots).collect()
    for r in first:
        assert r.mean_rmse == min(g.mean_rmse for g in grid if g.key == r.key)
    assert first == regression.fit_best(slots.repartition(7)).orderBy("key").collect() or np.allclose(
        [r.hour_coef for r in first], [r.hour_coef for r in regression.fit_best(slots.repartition(7)).orderBy("key").collect()]
    )


def test_one_bad_key_does_not_stop_the_others(spark):
    rows = [("ok", h, m, 3.0 * h + m) for h in range(3) for m in range(5)]
    rows += [("short", 8, 0, 1.0), ("flat", 8, 0, 7.0), ("flat", 9, 1, 7.0), ("flat", 10, 5, 7.0), ("flat", 11, 7, 7.0)]
    rows += [("hour", 8, m, 2.0 * m) for m in range(10)]
    slots = slots_of(spark, rows)
    ols = {r.key: r for r in regression.fit_ols(slots).collect()}
    assert {k: r.status for k, r in ols.items()} == {"ok": "ok", "short": "insufficient", "flat": "ok", "hour": "singular"}
    assert (ols["hour"].hour_coef, ols["hour"].minute_coef) == (0.0, pytest.approx(2.0))
    best = {r.key: r for r in regression.fit_best(slots).collect()}
    assert best["short"].status == "insufficient" and best["short"].intercept is None
    assert (best["flat"].hour_coef, best["flat"].minute_coef, best["flat"].intercept) == (0.0, 0.0, 7.0)


def test_rmse_over_own_and_over_all_rows(spark):
    slots = noisy(spark)
    models = regression.fit_ols(slots)
    rows = [(r.key, r.hour, r.minute, r.cumulative_votes) for r in slots.collect()]
    coefs = {r.key: (r.hour_coef, r.minute_coef, r.intercept) for r in models.collect()}
    for scope in ("own_key", "all_keys"):
        for r in regression.evaluate(models, slots, scope=scope).collect():
            a, b, c = coefs[r.key]
            errors = [y - a * h - b * m - c for k, h, m, y in rows if scope == "all_keys" or k == r.key]
            assert r.rmse == pytest.approx(np.sqrt(np.mean(np.square(errors))))
