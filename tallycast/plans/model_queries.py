"""Queries over models: regression, autoregression, forecasts, messages. Each with its SQL."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast import schemas
from tallycast.functions.times import MINUTES_PER_DAY
from tallycast.operators import autoregression as ar
from tallycast.operators import features, lagsums, outlook, regression
from tallycast.operators.series import last_seen
from tallycast.operators.slots import cumulative_slots as cumulative_slots_of
from tallycast.operators.slots import slot_time_series
from tallycast.plans import tables
from tallycast.plans.event_queries import SLOTS_SQL, cumulative_slots, slot_counts_all
from tallycast.plans.series_queries import MINUTES_SQL, minute_series
from tallycast.plans.sql_models import CV_SQL, OLS_SQL, ar_forecast_sql, ar_sql, linear_sql
from tallycast.plans.tables import KEYS_SQL, SHIPMENTS_SQL
from tallycast.session import materialize, scratch_path
from tallycast.sources.readers import decode_json, read_table_csv
from tallycast.sources.writers import load_models, save_models, write_messages

QUERIES = {}
ORACLES = {}


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Rounded doubles without negative zero, for comparison."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns})


def _round_sql(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in columns)


def fold_of_slot() -> Column:
    """The fold both sides can compute."""
    return (F.col("hour") * 60 + F.col("minute")) % 5


FOLDED_SQL = "folded AS (SELECT *, (hour * 60 + minute) % 5 AS fold FROM cumulative)"
_COEFS = ["hour_coef", "minute_coef", "intercept"]


def lr_fit_ols(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(regression.fit_ols(cumulative_slots(spark, folder)), _COEFS).drop("status")


QUERIES["lr_fit_ols"] = lr_fit_ols
ORACLES["lr_fit_ols"] = f"WITH {SLOTS_SQL}, {OLS_SQL} SELECT key, n, {_round_sql(_COEFS)} FROM ols"


def lr_cv_grid(spark: SparkSession, folder: str) -> DataFrame:
    grid = regression.cv_grid(cumulative_slots(spark, folder), fold=fold_of_slot())
    return rounded(grid, ["mean_rmse", *_COEFS]).drop("n", "grid")


QUERIES["lr_cv_grid"] = lr_cv_grid
ORACLES["lr_cv_grid"] = f"""WITH {SLOTS_SQL}, {FOLDED_SQL}, {CV_SQL}
SELECT key, CAST(reg_param AS DOUBLE) AS reg_param, CAST(elastic_net_param AS DOUBLE) AS elastic_net_param,
    {_round_sql(["mean_rmse", *_COEFS])} FROM cv"""


def lr_fit_best(spark: SparkSession, folder: str) -> DataFrame:
    best = regression.fit_best(cumulative_slots(spark, folder), fold=fold_of_slot())
    return rounded(best, ["mean_rmse", *_COEFS]).drop("n", "status")


QUERIES["lr_fit_best"] = lr_fit_best
ORACLES["lr_fit_best"] = f"""WITH {SLOTS_SQL}, {FOLDED_SQL}, {CV_SQL}
SELECT key, CAST(reg_param AS DOUBLE) AS reg_param, CAST(elastic_net_param AS DOUBLE) AS elastic_net_param,
    {_round_sql(["mean_rmse", *_COEFS])} FROM cv
QUALIFY row_number() OVER (PARTITION BY key ORDER BY cv.mean_rmse, grid) = 1"""


def lr_features_best(spark: SparkSession, folder: str) -> DataFrame:
    """The tuned model of hour and minute by the descent that takes any number of features."""
    best = features.fit_features(cumulative_slots(spark, folder), ["hour", "minute"], "cumulative_votes", fold=fold_of_slot())
    named = best.select(
        "key", "reg_param", "elastic_net_param", "mean_rmse",
        F.col("coefficients")[0].alias("hour_coef"), F.col("coefficients")[1].alias("minute_coef"), "intercept",
    )
    return rounded(named, ["mean_rmse", *_COEFS], 5)


QUERIES["lr_features_best"] = lr_features_best
ORACLES["lr_features_best"] = f"""WITH {SLOTS_SQL}, {FOLDED_SQL}, {CV_SQL}
SELECT key, CAST(reg_param AS DOUBLE) AS reg_param, CAST(elastic_net_param AS DOUBLE) AS elastic_net_param,
    {_round_sql(["mean_rmse", *_COEFS], 5)} FROM cv
QUALIFY row_number() OVER (PARTITION BY key ORDER BY cv.mean_rmse, grid) = 1"""
_PRICED = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey"]


def lr_six_features(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of line items explained by six columns, per return flag, without a penalty."""
    rows = tables.table(spark, folder, "lineitem")
    fold = F.pmod(F.col("l_orderkey"), F.lit(features.FOLDS))
    models = features.fit_features(rows, _PRICED, "l_extendedprice", key="l_returnflag", fold=fold, strengths=[0.0], shares=[0.0])
    coefficients = [F.col("coefficients")[i].alias(f"c{i + 1}") for i in range(len(_PRICED))]
    named = models.select(F.col("l_returnflag").alias("key"), "n", *coefficients, "intercept", "status")
    return rounded(named, [f"c{i + 1}" for i in range(len(_PRICED))] + ["intercept"], 4)


QUERIES["lr_six_features"] = lr_six_features
ORACLES["lr_six_features"] = f"""WITH {linear_sql("lineitem", "l_returnflag", _PRICED, "l_extendedprice")}
SELECT l_returnflag AS key, n, {_round_sql([f"c{i + 1}" for i in range(len(_PRICED))] + ["intercept"], 4)}, 'ok' AS status FROM linear"""


def score_slots(spark: SparkSession, folder: str) -> DataFrame:
    models = regression.fit_ols(cumulative_slots(spark, folder))
    return rounded(regression.score_slots(models, slot_counts_all(spark, folder)), ["scaled_votes"])


QUERIES["score_slots"] = score_slots
ORACLES["score_slots"] = f"""WITH {SLOTS_SQL}, {OLS_SQL}
SELECT ols.key, s.hour, s.minute, round(hour_coef * s.hour + minute_coef * s.minute + intercept, 6) + 0.0 AS scaled_votes
FROM ols, (SELECT DISTINCT hour, minute FROM slot) s"""


def lr_rmse_own(spark: SparkSession, folder: str) -> DataFrame:
    slots = cumulative_slots(spark, folder)
    return rounded(regression.evaluate(regression.fit_ols(slots), slots), ["rmse"])


QUERIES["lr_rmse_own"] = lr_rmse_own
_RMSE = "round(sqrt(avg((cumulative_votes - hour_coef * hour - minute_coef * minute - intercept) ** 2)), 6) AS rmse"
ORACLES["lr_rmse_own"] = f"WITH {SLOTS_SQL}, {OLS_SQL} SELECT key, {_RMSE} FROM cumulative JOIN ols USING (key) GROUP BY key"


def lr_rmse_all(spark: SparkSession, folder: str) -> DataFrame:
    slots = cumulative_slots(spark, folder)
    return rounded(regression.evaluate(regression.fit_ols(slots), slots, scope="all_keys"), ["rmse"])


QUERIES["lr_rmse_all"] = lr_rmse_all
ORACLES["lr_rmse_all"] = f"WITH {SLOTS_SQL}, {OLS_SQL} SELECT ols.key, {_RMSE} FROM cumulative, ols GROUP BY ols.key"


def model_registry_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Models stored under a run name and read back."""
    models = lr_fit_ols(spark, folder)
    path = scratch_path(spark, "models")
    save_models(models, path, "latest")
    return load_models(spark, path, "latest")


QUERIES["model_registry_roundtrip"] = model_registry_roundtrip
ORACLES["model_registry_roundtrip"] = ORACLES["lr_fit_ols"]


# Batch path: the cumulative slots in clock order. Live path: the minute series.
SLOT_SERIES_SQL = SLOTS_SQL + """,
slot_series AS (SELECT key, TIMESTAMP '2024-01-01' + to_minutes(hour * 60 + minute) AS ts, cumulative_votes AS total
    FROM cumulative)"""


def slot_series(spark: SparkSession, folder: str) -> DataFrame:
    return slot_time_series(cumulative_slots(spark, folder)).select(
        "key", F.col("slot_ts").alias("ts"), F.col("cumulative_votes").alias("total")
    )


def ar_lag_features(spark: SparkSession, folder: str) -> DataFrame:
    return ar.lag_features(minute_series(spark, folder))


QUERIES["ar_lag_features"] = ar_lag_features
_LAGS = ", ".join(f"l{i}" for i in range(1, 6))
ORACLES["ar_lag_features"] = f"""WITH {MINUTES_SQL}, {ar_sql("minutes", "key", "ts", 5)}
SELECT key, ts, total, d, {_LAGS} FROM lagged"""


def ar_normal_equations(spark: SparkSession, folder: str) -> DataFrame:
    equations = ar.normal_equations(minute_series(spark, folder))
    return equations.withColumns({f"t{i}": F.col("tail")[i - 1] for i in range(1, 6)}).drop("tail")


QUERIES["ar_normal_equations"] = ar_normal_equations
_SUMS = ", ".join([f"g_{i}_{j}" for i in range(1, 6) for j in range(i, 6)] + [f"r_{i}" for i in range(1, 6)])
_TAILS = ", ".join(f"CAST(t{i} AS DOUBLE) AS t{i}" for i in range(1, 6))
ORACLES["ar_normal_equations"] = f"""WITH {MINUTES_SQL}, {ar_sql("minutes", "key", "ts", 5)}
SELECT key, n, {_SUMS}, last_ts, last_value, {_TAILS} FROM equations"""


def _phi(models: DataFrame, lags: int) -> DataFrame:
    phi = [(F.round(F.col("phi")[i - 1], 6) + F.lit(0.0)).alias(f"phi_{i}") for i in range(1, lags + 1)]
    return models.select("key", "n", "last_ts", "last_value", *phi)


def _phi_sql(series_sql: str, source: str, lags: int) -> str:
    return f"""WITH {series_sql}, {ar_sql(source, "key", "ts", lags)}
SELECT key, n, last_ts, last_value, {_round_sql([f"phi_{i}" for i in range(1, lags + 1)])} FROM phi"""


def _forecast_sql(series_sql: str, source: str, lags: int, horizon: int) -> str:
    return f"""WITH {series_sql}, {ar_sql(source, "key", "ts", lags)}, {ar_forecast_sql("key", lags, horizon)}
SELECT key, step, ts, round(forecast, 4) + 0.0 AS forecast FROM ahead"""


def ar_fit(spark: SparkSession, folder: str) -> DataFrame:
    return _phi(ar.fit(minute_series(spark, folder)), 5)


QUERIES["ar_fit"] = ar_fit
ORACLES["ar_fit"] = _phi_sql(MINUTES_SQL, "minutes", 5)


def ar_fit_slots(spark: SparkSession, folder: str) -> DataFrame:
    return _phi(ar.fit(slot_series(spark, folder)), 5)


QUERIES["ar_fit_slots"] = ar_fit_slots
ORACLES["ar_fit_slots"] = _phi_sql(SLOT_SERIES_SQL, "slot_series", 5)


def ar_fit_p1(spark: SparkSession, folder: str) -> DataFrame:
    return _phi(ar.fit(minute_series(spark, folder), lags=1), 1)


QUERIES["ar_fit_p1"] = ar_fit_p1
ORACLES["ar_fit_p1"] = _phi_sql(MINUTES_SQL, "minutes", 1)


def ar_fit_p2(spark: SparkSession, folder: str) -> DataFrame:
    return _phi(ar.fit(minute_series(spark, folder), lags=2), 2)


QUERIES["ar_fit_p2"] = ar_fit_p2
ORACLES["ar_fit_p2"] = _phi_sql(MINUTES_SQL, "minutes", 2)


def ar_fit_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Maximum-likelihood models of the full order beside the conditional ones. Tests hold them against a Kalman filter."""
    series = materialize(minute_series(spark, folder), "minutes")
    models = lagsums.fit_exact(series)
    other = ar.fit(series).select(F.col("key").alias("_key"), F.col("phi").alias("_phi"))
    both = models.join(other, F.col("key").eqNullSafe(F.col("_key")))
    rows = both.select(
        "key", "n", "status", "sigma2", "log_likelihood",
        *[F.col("phi")[i].alias(f"phi_{i + 1}") for i in range(5)],
        *[F.col("_phi")[i].alias(f"conditional_{i + 1}") for i in range(5)],
    )
    return rounded(rows, [c for c in rows.columns if c not in ("key", "n", "status")])


def ar_fit_exact_p1(spark: SparkSession, folder: str) -> DataFrame:
    models = lagsums.fit_exact(minute_series(spark, folder), lags=1)
    return rounded(
        models.select("key", "n", "last_ts", "last_value", "sigma2", "log_likelihood", F.col("phi")[0].alias("phi_1")),
        ["sigma2", "log_likelihood", "phi_1"], 5,
    )


def ar_forecast_exact(spark: SparkSession, folder: str) -> DataFrame:
    """The live horizon ahead by maximum-likelihood models of order 1."""
    return rounded(ar.forecast(lagsums.fit_exact(minute_series(spark, folder), lags=1)), ["forecast"], 3)


QUERIES["ar_fit_exact"] = ar_fit_exact
QUERIES["ar_fit_exact_p1"] = ar_fit_exact_p1
QUERIES["ar_forecast_exact"] = ar_forecast_exact
# The slope of the likelihood changes sign once between -1 and 1: halve the interval until it is one number.
_EXACT_SQL = f"""WITH RECURSIVE {MINUTES_SQL},
diffs AS (SELECT *, total - lag(total) OVER (PARTITION BY key ORDER BY ts) AS d FROM minutes),
lagged AS (SELECT *, lag(d) OVER (PARTITION BY key ORDER BY ts) AS l1 FROM diffs),
sums AS (SELECT key, count(d) AS n, CAST(sum(d * d) AS DOUBLE) AS d00, CAST(sum(d * l1) AS DOUBLE) AS d01,
    CAST(sum(d * d) - arg_min(d * d, ts) - arg_max(d * d, ts) AS DOUBLE) AS d11, max(ts) AS last_ts,
    arg_max(CAST(total AS DOUBLE), ts) AS last_value, arg_max(CAST(d AS DOUBLE), ts) AS t1 FROM lagged GROUP BY key),
halved AS (SELECT sums.*, CAST(-1 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high, 0 AS round FROM sums
    UNION ALL SELECT * EXCLUDE (middle, slope) REPLACE (CASE WHEN slope < 0 THEN middle ELSE low END AS low, CASE WHEN slope < 0 THEN high ELSE middle END AS high,
        round + 1 AS round) FROM (SELECT *, n * (d11 * middle - d01) * (1 - middle * middle)
        + middle * (d00 - 2 * d01 * middle + d11 * middle * middle) AS slope FROM (SELECT *, (low + high) / 2 AS middle FROM halved WHERE round < 60))),
fitted AS (SELECT key, n, last_ts, last_value, t1, low AS phi_1, (d00 - 2 * d01 * low + d11 * low * low) / n AS sigma2 FROM halved WHERE round = 60),
phi AS (SELECT *, -0.5 * n * (ln(2 * pi() * sigma2) + 1) + 0.5 * ln(1 - phi_1 * phi_1) AS log_likelihood FROM fitted)"""
ORACLES["ar_fit_exact_p1"] = f"""{_EXACT_SQL}
SELECT key, n, last_ts, last_value, {_round_sql(["sigma2", "log_likelihood", "phi_1"], 5)} FROM phi"""
ORACLES["ar_forecast_exact"] = f"""{_EXACT_SQL},
{ar_forecast_sql("key", 1, ar.LIVE_HORIZON)}
SELECT key, step, ts, round(forecast, 3) + 0.0 AS forecast FROM ahead"""


def _live_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return ar.forecast(ar.fit(minute_series(spark, folder)))


def ar_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_live_forecast(spark, folder), ["forecast"], 4)


QUERIES["ar_forecast"] = ar_forecast
ORACLES["ar_forecast"] = _forecast_sql(MINUTES_SQL, "minutes", 5, ar.LIVE_HORIZON)


def ar_forecast_slots(spark: SparkSession, folder: str) -> DataFrame:
    ahead = ar.forecast(ar.fit(slot_series(spark, folder)), ar.BATCH_HORIZON)
    return rounded(ahead, ["forecast"], 4)


def ar_registry_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Autoregressive models stored, loaded without knowing their schema, and run ten steps ahead."""
    path = scratch_path(spark, "registry")
    save_models(ar.fit(slot_series(spark, folder)), path, "latest")
    return rounded(ar.forecast(load_models(spark, path, "latest"), ar.BATCH_HORIZON), ["forecast"], 4)


def stamped_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """A forecast stored by key and minute only, stamped with each key's last time when it is read."""
    series = materialize(slot_series(spark, folder), "slots")
    path = scratch_path(spark, "flat")
    ahead = ar.forecast(ar.fit(series), ar.BATCH_HORIZON)
    flat = ahead.select(F.col("key").alias("candidate_id"), F.col("step").alias("minute"), "forecast")
    flat.write.csv(path, header=True)
    stored = read_table_csv(spark, path, schemas.FORECAST).withColumnsRenamed({"candidate_id": "key"})
    stamped = outlook.stamp_forecast(stored, last_seen(series))
    return rounded(stamped.select("key", F.col("minute").alias("step"), "ts", "forecast"), ["forecast"], 4)


QUERIES["ar_forecast_slots"] = ar_forecast_slots
QUERIES["ar_registry_forecast"] = ar_registry_forecast
QUERIES["stamped_forecast"] = stamped_forecast
ORACLES["ar_forecast_slots"] = _forecast_sql(SLOT_SERIES_SQL, "slot_series", 5, ar.BATCH_HORIZON)
ORACLES["ar_registry_forecast"] = ORACLES["stamped_forecast"] = ORACLES["ar_forecast_slots"]


DAILY_SQL = f"""{SHIPMENTS_SQL},
days AS (SELECT key, ts, count(*) AS votes FROM ship GROUP BY 1, 2),
daily AS (SELECT *, CAST(sum(votes) OVER (PARTITION BY key ORDER BY ts) AS BIGINT) AS total FROM days)"""


def shipments_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """Cumulative shipments per key; the times are whole days."""
    return cumulative_slots_of(tables.shipments(spark, folder), slot="minute").withColumnRenamed("cumulative_votes", "total")


QUERIES["shipments_by_day"] = shipments_by_day
ORACLES["shipments_by_day"] = f"WITH {DAILY_SQL} SELECT key, ts, votes, total FROM daily"


def shipments_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Ten days ahead of the daily series."""
    models = ar.fit(shipments_by_day(spark, folder))
    return rounded(ar.forecast(models, ar.BATCH_HORIZON, minutes=MINUTES_PER_DAY), ["forecast"], 4)


QUERIES["shipments_forecast"] = shipments_forecast
ORACLES["shipments_forecast"] = f"""WITH {DAILY_SQL}, {ar_sql("daily", "key", "ts", 5)},
{ar_forecast_sql("key", 5, ar.BATCH_HORIZON, 1440)}
SELECT key, step, ts, round(forecast, 4) + 0.0 AS forecast FROM ahead"""

_AHEAD_SQL = f"{MINUTES_SQL}, {ar_sql('minutes', 'key', 'ts', 5)}, {ar_forecast_sql('key', 5, ar.LIVE_HORIZON)}"


def projected_winner(spark: SparkSession, folder: str) -> DataFrame:
    return outlook.projected_winner(_live_forecast(spark, folder), tables.key_dimension(spark))


QUERIES["projected_winner"] = projected_winner
ORACLES["projected_winner"] = f"""WITH {_AHEAD_SQL}, {KEYS_SQL}
SELECT key, CAST(trunc(forecast) AS BIGINT) AS votes FROM ahead JOIN keys USING (key)
WHERE step = {ar.LIVE_HORIZON} ORDER BY forecast DESC, rank LIMIT 1"""


def history_and_forecast(spark: SparkSession, folder: str) -> DataFrame:
    history = materialize(minute_series(spark, folder), "minutes")
    both = outlook.history_and_forecast(history, ar.forecast(ar.fit(history)))
    return rounded(both, ["votes"], 4)


QUERIES["history_and_forecast"] = history_and_forecast
ORACLES["history_and_forecast"] = f"""WITH {_AHEAD_SQL}
SELECT key, 'history' AS kind, ts, CAST(total AS DOUBLE) AS votes FROM minutes
UNION ALL SELECT key, 'forecast', ts, round(forecast, 4) + 0.0 FROM ahead"""


def publish_messages(spark: SparkSession, folder: str) -> DataFrame:
    history = materialize(minute_series(spark, folder), "minutes")
    ahead = rounded(ar.forecast(ar.fit(history)), ["forecast"], 4)
    return outlook.publish_messages(history, ahead)


QUERIES["publish_messages"] = publish_messages
_SPANS_SQL = "spans AS (SELECT key, min(ts) AS first_ts, max(ts) AS end_ts FROM minutes GROUP BY key)"
_PART_SQL = f"CAST(floor(date_diff('minute', first_ts, {{}}) / {outlook.POINTS_PER_MESSAGE}) AS INT)"
ORACLES["publish_messages"] = f"""WITH {_AHEAD_SQL}, {_SPANS_SQL},
past AS (SELECT key, {_PART_SQL.format("ts")} AS part, {_PART_SQL.format("end_ts")} + 1 AS parts,
    list({{vote_time: strftime(ts, '%Y-%m-%d %H:%M:%S'), cumulative_votes: CAST(total AS DOUBLE)}} ORDER BY ts) AS history
    FROM minutes JOIN spans USING (key) GROUP BY 1, 2, 3),
coming AS (SELECT key,
    list({{time: strftime(ts, '%Y-%m-%d %H:%M:%S'), votes: round(forecast, 4) + 0.0}} ORDER BY ts) AS forecast
    FROM ahead GROUP BY key)
SELECT key, CAST(0 AS BIGINT) AS publication, part, parts, CAST(to_json({{candidate_id: key, publication: 0, part: part, parts: parts,
    forecast: CASE WHEN part = parts - 1 THEN forecast ELSE [] END, historical_data: history}}) AS VARCHAR) AS value
FROM past JOIN coming USING (key)"""


def message_contents(spark: SparkSession, folder: str) -> DataFrame:
    """The published messages written as text, read and decoded again, one row per point."""
    path = scratch_path(spark, "messages")
    write_messages(publish_messages(spark, folder), path)
    decoded = decode_json(spark.read.text(path), schemas.MESSAGE)
    return outlook.points_of(decoded).drop("publication", "parts")


QUERIES["message_contents"] = message_contents
ORACLES["message_contents"] = f"""WITH {_AHEAD_SQL}, {_SPANS_SQL}
SELECT {_PART_SQL.format("ts")} AS part, key AS candidate_id, 'history' AS kind,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, CAST(total AS DOUBLE) AS votes
FROM minutes JOIN spans USING (key)
UNION ALL
SELECT {_PART_SQL.format("end_ts")}, key, 'forecast', strftime(ts, '%Y-%m-%d %H:%M:%S'), round(forecast, 4) + 0.0
FROM ahead JOIN spans USING (key)"""
