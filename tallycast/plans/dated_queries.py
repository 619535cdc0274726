"""Queries over dated models, raw rows' quantiles and stored dimensions. Each with its SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.functions.times import MINUTES_PER_DAY, minute_start
from tallycast.operators import quantiles, regression
from tallycast.operators.buckets import Buckets
from tallycast.operators.autoregression import LIVE_HORIZON
from tallycast.operators.lookup import verify
from tallycast.operators.slots import slot_counts
from tallycast.operators.versions import in_force
from tallycast.plans import tables
from tallycast.plans.event_queries import ORACLES as EVENT_ORACLES
from tallycast.plans.sql_models import OLS_SQL
from tallycast.plans.stream_queries import ORACLES as STREAM_ORACLES
from tallycast.plans.stream_queries import drained, event_stream, refit_forecasts
from tallycast.plans.tables import EVENTS_SQL, KEYS_SQL
from tallycast.session import materialize, scratch_path
from tallycast.streaming.winner import LiveWinner

QUERIES = {}
ORACLES = {}


def scores_in_force(spark: SparkSession, folder: str) -> DataFrame:
    """Every minute of a key scored by the model in force: that of the key's last day that had one, trained on that day alone."""
    minute = F.col("epoch_minute")
    minutes = materialize(
        slot_counts(tables.events(spark, folder), slot="minute").withColumns(
            {
                "day": F.floor(minute / MINUTES_PER_DAY).cast("bigint"),
                "hour": F.floor(F.pmod(minute, F.lit(MINUTES_PER_DAY)) / 60).cast("int"),
                "minute": F.pmod(minute, F.lit(60)).cast("int"),
            }
        ),
        "minutes",
    )
    so_far = W.partitionBy("key", "day").orderBy("epoch_minute").rowsBetween(W.unboundedPreceding, W.currentRow)  # a day of minutes at most
    daily = minutes.withColumn("cumulative_votes", F.sum("votes").over(so_far)).withColumn("series", F.struct("key", "day"))
    models = regression.fit_ols(daily, key="series").filter("status = 'ok'").select(
        F.col("series.key").alias("key"),
        F.col("series.day").alias("model_day"),
        ((F.col("series.day") + 1) * MINUTES_PER_DAY).alias("since"),
        "hour_coef", "minute_coef", "intercept",
    )
    scored = in_force(minutes.drop("day"), models, ["key"], "epoch_minute", "since", bits=10)
    return scored.select(
        "key", minute_start(minute).alias("ts"), "votes", "model_day", (F.round(regression.predict(), 4) + F.lit(0.0)).alias("scaled_votes")
    )


QUERIES["scores_in_force"] = scores_in_force
ORACLES["scores_in_force"] = f"""WITH {EVENTS_SQL},
minutes AS (SELECT key, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS ts,
    CAST(epoch(date_trunc('minute', ts)) AS BIGINT) // 60 AS m, count(*) AS votes FROM ev GROUP BY 1, 2, 3),
cumulative AS (SELECT key || '|' || (m // {MINUTES_PER_DAY}) AS key, (m % {MINUTES_PER_DAY}) // 60 AS hour, m % 60 AS minute,
    sum(votes) OVER (PARTITION BY key, m // {MINUTES_PER_DAY} ORDER BY m) AS cumulative_votes FROM minutes),
{OLS_SQL},
models AS (SELECT split_part(ols.key, '|', 1) AS key, CAST(split_part(ols.key, '|', 2) AS BIGINT) AS model_day,
    (model_day + 1) * {MINUTES_PER_DAY} AS since, ols.hour_coef, ols.minute_coef, intercept FROM ols JOIN slopes USING (key)
    WHERE slopes.n >= {regression.MIN_ROWS} AND cov_hh * cov_mm - cov_hm * cov_hm > cov_hh * cov_mm * 1e-12)
SELECT r.key, r.ts, r.votes, model_day,
    round(hour_coef * ((r.m % {MINUTES_PER_DAY}) // 60) + minute_coef * (r.m % 60) + intercept, 4) + 0.0 AS scaled_votes
FROM minutes r ASOF LEFT JOIN models v ON r.key = v.key AND r.m >= v.since"""


def _boxed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = tables.table(spark, folder, "events").select(
        F.col("event_id").alias("arrival"), F.col("event_type").alias("key"), F.hour("ts").alias("hour"), "value"
    )
    return quantiles.event_boxes(rows, ["key", "hour"], "value")


def event_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Box-plot statistics of raw events per key and hour, exact however many there are."""
    boxes, _ = _boxed(spark, folder)
    return boxes.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("q1", "median", "q3")})


def event_box_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """The events beyond the whiskers of their box, as rows."""
    return _boxed(spark, folder)[1]


QUERIES["event_boxes"] = event_boxes
QUERIES["event_box_outliers"] = event_box_outliers
_EVENT_BOX_SQL = """rows_ AS (SELECT event_id AS arrival, event_type AS key, CAST(hour(ts) AS INT) AS hour, value FROM events WHERE value IS NOT NULL),
quart AS (SELECT key, hour, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
    FROM rows_ GROUP BY 1, 2),
placed AS (SELECT *, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM rows_ JOIN quart USING (key, hour))"""
ORACLES["event_boxes"] = f"""WITH {_EVENT_BOX_SQL}
SELECT key, hour, count(*) AS n, round(any_value(q1), 6) + 0.0 AS q1, round(any_value(median), 6) + 0.0 AS median,
    round(any_value(q3), 6) + 0.0 AS q3, min(value) FILTER (inside) AS whisker_low, max(value) FILTER (inside) AS whisker_high,
    count(*) FILTER (NOT inside) AS n_outliers FROM placed GROUP BY key, hour"""
ORACLES["event_box_outliers"] = f"WITH {_EVENT_BOX_SQL} SELECT arrival, key, hour, value FROM placed WHERE NOT inside"


def stream_lookup_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The entity lookup per micro-batch over a dimension stored once in buckets."""
    stored = Buckets.store(tables.registered(spark, folder), scratch_path(spark, "registered"), "entity")
    written = spark.createDataFrame([], "arrival bigint, entity bigint, name string").schema

    def look_up(batch: DataFrame) -> DataFrame:
        batch = materialize(batch.select("arrival", "entity"), "batch")
        return stored.look_up(batch).select("arrival", "entity", "name")

    return drained(spark, event_stream(spark, folder), "append", look_up, written).drop("batch_id")


QUERIES["stream_lookup_buckets"] = stream_lookup_buckets
ORACLES["stream_lookup_buckets"] = EVENT_ORACLES["entity_lookup"]


def stream_verify_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Verification per micro-batch; references and live vectors with their norms are prepared once, in buckets."""
    references = Buckets.store(tables.references(spark, folder), scratch_path(spark, "references"), "entity")
    faces = Buckets.store(tables.faces(spark, folder), scratch_path(spark, "faces"), "face")
    written = spark.createDataFrame([], "arrival bigint, entity bigint, key string, verdict string").schema

    def check(batch: DataFrame) -> DataFrame:
        shown = materialize(tables.shown_faces(batch).select("arrival", "entity", "key", "face"), "batch")
        live = faces.look_up(shown)
        known = references.asked(batch.sparkSession, shown, "entity")
        return verify(live, known, "live", F.col("live_norm")).select("arrival", "entity", "key", "verdict")

    return drained(spark, event_stream(spark, folder), "append", check, written).drop("batch_id")


QUERIES["stream_verify_buckets"] = stream_verify_buckets
ORACLES["stream_verify_buckets"] = EVENT_ORACLES["verify_events"]


WINNER_BATCHES = 8  # equal ranges of refits, a micro-batch each


def winner_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of the projected winner as refits' forecasts come in, in eight micro-batches."""
    last = refit_forecasts(spark, folder).filter(F.col("step") == LIVE_HORIZON)
    ahead = materialize(last.select("key", F.col("refit_arrival").alias("at"), "forecast"), "ahead")
    low, high = ahead.agg(F.min("at"), F.max("at")).first()
    live = LiveWinner(scratch_path(spark, "winner"), tables.key_dimension(spark))
    if low is not None:
        width = (high - low) // WINNER_BATCHES + 1
        for i in range(WINNER_BATCHES):
            live.process(ahead.filter((F.col("at") >= low + i * width) & (F.col("at") < low + (i + 1) * width)), i)
    return live.changes(spark)


QUERIES["winner_changes"] = winner_changes
ORACLES["winner_changes"] = f"""WITH forecasts AS ({STREAM_ORACLES["refit_forecasts"]}),
ahead AS (SELECT key, refit_arrival AS due, forecast FROM forecasts WHERE step = {LIVE_HORIZON}), {KEYS_SQL},
ends AS (SELECT min(due) AS low, (max(due) - min(due)) // {WINNER_BATCHES} + 1 AS width FROM ahead),
placed AS (SELECT key, rank, (due - low) // width AS batch_id, due, forecast FROM ahead JOIN keys USING (key), ends),
batches AS (SELECT unnest(range({WINNER_BATCHES})) AS batch_id),
latest AS (SELECT b.batch_id, p.key, any_value(rank) AS rank, arg_max(forecast, due) AS forecast
    FROM batches b JOIN placed p ON p.batch_id <= b.batch_id GROUP BY 1, 2),
led AS (SELECT batch_id, first(key ORDER BY forecast DESC, rank) AS key, max(forecast) AS forecast FROM latest GROUP BY 1),
moved AS (SELECT *, lag(key) OVER (ORDER BY batch_id) AS previous FROM led)
SELECT batch_id, key, CAST(trunc(forecast) AS BIGINT) AS votes, previous FROM moved WHERE previous IS DISTINCT FROM key"""
