"""Streaming queries, run over all files that are there and then returned as tables. Each with its SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast import schemas
from tallycast.functions.times import TIME_FORMAT, parse_time
from tallycast.operators import autoregression as ar
from tallycast.operators import cleaning, lookup, outlook, refit, triggers
from tallycast.plans import tables
from tallycast.plans.event_queries import ORACLES as EVENT_ORACLES
from tallycast.plans.series_queries import TRIGGERS_SQL
from tallycast.plans.sql_models import ar_forecast_sql, ar_sql
from tallycast.plans.tables import EVENTS_SQL, RAW_SQL
from tallycast.session import materialize, scratch_path
from tallycast.sources.readers import decode_json, live_events, stream_files, stream_topics
from tallycast.sources.writers import json_messages, write_messages, write_topics
from tallycast.streaming import jobs
from tallycast.streaming.carried import CarriedRefit
from tallycast.streaming.refit import LiveRefit
from tallycast.streaming.sinks import latest_rows, read_batches, save_batches

QUERIES = {}
ORACLES = {}


BATCHES = 3  # micro-batches that a query's feed arrives in
FILES = 2  # files of a micro-batch


def fed(spark: SparkSession, rows: DataFrame, order: str, label: str) -> str:
    """The rows in one write as files of ascending ranges of ``order``, dated in that order, as files of a feed would be."""
    path = scratch_path(spark, label)
    rows.repartitionByRange(BATCHES * FILES, order).write.parquet(path)
    java = spark.sparkContext._jvm
    place = java.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((s.getPath() for s in system.listStatus(place) if s.getPath().getName().startswith("part-")), key=lambda x: x.getName())
    for i, file in enumerate(files):
        system.setTimes(file, FIRST_FILE + 1000 * i, -1)
    return path


FIRST_FILE = 1_700_000_000_000  # when a feed's first file was written, in milliseconds


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.table(spark, folder, "events")
    path = fed(spark, events, "event_id", "feed")
    source = stream_files(spark, path, events.schema, "parquet", maxFilesPerTrigger=str(FILES))
    return source.select(
        F.col("event_id").alias("arrival"), F.col("user_id").alias("entity"), F.col("event_type").alias("key"), "ts", "props"
    )


def message_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events written as JSON messages and read as a stream of text, then decoded and cleaned."""
    path = scratch_path(spark, "topic")
    wire = tables.raw_events(spark, folder).select(
        F.col("entity").cast("string").alias("Voter_id"),
        F.col("key").alias("Candidate_id"),
        F.col("event_time").alias("Vote_Time"),
        F.format_string("picture/%d", "entity").alias("Voter_image"),
    )
    write_messages(json_messages(wire, "Candidate_id"), path)
    schema = spark.createDataFrame([], "value string").schema
    messages = stream_files(spark, path, schema, "text", maxFilesPerTrigger="1")
    return cleaning.clean_events(live_events(messages))


def drained(spark: SparkSession, stream: DataFrame, mode: str, transform=None, schema=None) -> DataFrame:
    """Run a stream over everything available and read back what its batches wrote."""
    path = scratch_path(spark, "stream")
    save_batches(stream, f"{path}/out", f"{path}/checkpoint", mode, transform).awaitTermination()
    return read_batches(spark, f"{path}/out", schema or stream.schema)


def stream_running_totals(spark: SparkSession, folder: str) -> DataFrame:
    stream = jobs.running_totals(event_stream(spark, folder))
    return latest_rows(drained(spark, stream, "update"), ["key"])


QUERIES["stream_running_totals"] = stream_running_totals
ORACLES["stream_running_totals"] = f"WITH {EVENTS_SQL} SELECT key, count(*) AS running_total FROM ev GROUP BY key"


def stream_hourly_counts(spark: SparkSession, folder: str) -> DataFrame:
    stream = jobs.hourly_counts(event_stream(spark, folder))
    return latest_rows(drained(spark, stream, "update"), ["key", "hour_start"])


QUERIES["stream_hourly_counts"] = stream_hourly_counts
ORACLES["stream_hourly_counts"] = f"""WITH {EVENTS_SQL}
SELECT key, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_start, count(*) AS n FROM ev GROUP BY 1, 2"""


def stream_hourly_counts_late(spark: SparkSession, folder: str) -> DataFrame:
    """Hours of the raw feed, in which sign-ups carry times months away from their neighbours': all count."""
    raw = tables.raw_events(spark, folder).withColumn("_order", F.pmod(F.xxhash64("entity", "event_time"), F.lit(1000)))
    path = fed(spark, raw, "_order", "late-feed")
    source = stream_files(spark, path, raw.schema, "parquet", maxFilesPerTrigger=str(FILES))
    stream = jobs.hourly_counts(cleaning.clean_events(source))
    return latest_rows(drained(spark, stream, "update"), ["key", "hour_start"])


QUERIES["stream_hourly_counts_late"] = stream_hourly_counts_late
ORACLES["stream_hourly_counts_late"] = f"""WITH {RAW_SQL}
SELECT key, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_start, count(*) AS n
FROM parsed WHERE ts IS NOT NULL GROUP BY 1, 2"""


def stream_json_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages through the JSON sink and source: running totals of those whose time parses."""
    stream = jobs.running_totals(message_stream(spark, folder))
    return latest_rows(drained(spark, stream, "update"), ["key"])


QUERIES["stream_json_messages"] = stream_json_messages
ORACLES["stream_json_messages"] = f"WITH {RAW_SQL} SELECT key, count(ts) AS running_total FROM parsed GROUP BY key"


def stream_several_topics(spark: SparkSession, folder: str) -> DataFrame:
    """A topic per key, all read as one stream: messages and parsed ones of each topic."""
    path = scratch_path(spark, "topics")
    wire = tables.raw_events(spark, folder).select(
        F.col("entity").cast("string").alias("Voter_id"), F.col("key").alias("Candidate_id"), F.col("event_time").alias("Vote_Time")
    )
    write_topics(json_messages(wire, "Candidate_id"), path, F.concat(F.lit("data_"), F.col("key")))
    raw = live_events(stream_topics(spark, path, maxFilesPerTrigger="2"))
    counted = raw.groupBy("topic").agg(F.count("*").alias("messages"), F.count(parse_time(F.col("event_time"))).alias("parsed"))
    return latest_rows(drained(spark, counted, "update"), ["topic"])


QUERIES["stream_several_topics"] = stream_several_topics
ORACLES["stream_several_topics"] = f"""WITH {RAW_SQL}
SELECT 'data_' || key AS topic, count(*) AS messages, count(ts) AS parsed FROM parsed GROUP BY key"""


def stream_latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    messages = event_stream(spark, folder).select("key", "arrival", "entity", "ts")
    return latest_rows(drained(spark, jobs.latest_per_key(messages, offset="arrival"), "update"), ["key"])


QUERIES["stream_latest_per_key"] = stream_latest_per_key
ORACLES["stream_latest_per_key"] = EVENT_ORACLES["latest_per_key"]


def stream_entity_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The lookup runs as a batch join per micro-batch, against the dimension as it is then."""
    stream = event_stream(spark, folder)
    small = lookup.is_small(tables.registered(spark, folder))

    def look_up(batch: DataFrame) -> DataFrame:
        known = tables.registered(batch.sparkSession, folder)
        return lookup.entity_lookup(batch, known, small=small).select("arrival", "entity", "name")

    written = spark.createDataFrame([], "arrival bigint, entity bigint, name string").schema
    return drained(spark, stream, "append", look_up, written).drop("batch_id")


QUERIES["stream_entity_lookup"] = stream_entity_lookup
ORACLES["stream_entity_lookup"] = EVENT_ORACLES["entity_lookup"]


def stream_verify(spark: SparkSession, folder: str) -> DataFrame:
    stream = event_stream(spark, folder)
    small = lookup.is_small(tables.table(spark, folder, "embeddings"))

    def check(batch: DataFrame) -> DataFrame:
        session = batch.sparkSession
        live = tables.live_events(batch, tables.table(session, folder, "embeddings"), small)
        checked = lookup.verify(live, tables.references(session, folder), "live", F.col("live_norm"), small=small)
        return checked.select("arrival", "entity", "key", "verdict")

    written = spark.createDataFrame([], "arrival bigint, entity bigint, key string, verdict string").schema
    return drained(spark, stream, "append", check, written).drop("batch_id")


QUERIES["stream_verify"] = stream_verify
ORACLES["stream_verify"] = EVENT_ORACLES["verify_events"]


# The series each refit saw, and its forecasts.
SNAPSHOT_SQL = TRIGGERS_SQL + """,
running AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY arrival) AS running_total FROM ev),
seen AS (SELECT t.arrival AS refit_arrival, t.ts AS refit_ts, r.key, CAST(date_trunc('minute', r.ts) AS TIMESTAMP) AS ts,
    last(running_total ORDER BY r.ts, r.arrival) AS total FROM trigger_at t JOIN running r ON r.arrival <= t.arrival GROUP BY 1, 2, 3, 4),
grid AS (SELECT refit_arrival, refit_ts, key, unnest(generate_series(min(ts), max(ts), INTERVAL 1 MINUTE)) AS ts
    FROM seen GROUP BY 1, 2, 3),
snapshots AS (SELECT grid.*, last_value(total IGNORE NULLS) OVER (PARTITION BY refit_arrival, key ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
    FROM grid LEFT JOIN seen USING (refit_arrival, refit_ts, key, ts))"""

_BY = "refit_arrival, refit_ts, key"


def _one_lag_relations() -> str:
    walk = ar_sql("snapshots", _BY, "ts", 1)
    # Without any movement the minimum-norm coefficient is 0.
    walk = walk.replace("(a0_1_2) / a0_1_1 AS phi_1", "coalesce(a0_1_2 / nullif(a0_1_1, 0), 0) AS phi_1")
    return f"WITH {SNAPSHOT_SQL}, {walk}, {ar_forecast_sql(_BY, 1, 45)}"


def refit_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """Every refit of the history in one batch, order 1."""
    events = tables.events(spark, folder)
    published = refit.refit_forecasts(events, triggers.trigger_points(events), lags=1)
    return published.withColumn("forecast", F.round("forecast", 4) + F.lit(0.0))


QUERIES["refit_forecasts"] = refit_forecasts
ORACLES["refit_forecasts"] = f"""{_one_lag_relations()}
SELECT {_BY}, step, ts, round(forecast, 4) + 0.0 AS forecast FROM ahead
WHERE (refit_arrival, key) IN (SELECT (refit_arrival, key) FROM equations WHERE n > 0)"""


def refit_models(spark: SparkSession, folder: str) -> DataFrame:
    """Every refit's model of the full order; coefficients where they are well determined."""
    events = tables.events(spark, folder)
    fired = materialize(triggers.trigger_points(events), "triggers")
    parts = materialize(refit.history_parts(events, fired), "parts")
    models = refit.refit_models(parts, fired)
    ok = F.col("status") == "ok"
    phi = [F.when(ok, F.round(F.col("phi")[i], 6) + F.lit(0.0)).alias(f"phi_{i + 1}") for i in range(5)]
    return models.select("refit_arrival", "refit_ts", "key", "n", "last_ts", "last_value", "status", *phi)


QUERIES["refit_models"] = refit_models
# A pivot of 0 ends the elimination: everything behind it is null.
_FULL_SQL = ar_sql("snapshots", _BY, "ts", 5)
_RANK = "n >= 10 AND " + " AND ".join(f"coalesce(a4_{i}_{i} > 1e-9, false)" for i in range(1, 6))
_STATUS = f"CASE WHEN n < 1 THEN 'insufficient' WHEN {_RANK} THEN 'ok' ELSE 'singular' END"
_PHI = ", ".join(f"CASE WHEN {_RANK} THEN round(phi_{i}, 6) + 0.0 END AS phi_{i}" for i in range(1, 6))
ORACLES["refit_models"] = f"""WITH {SNAPSHOT_SQL}, {_FULL_SQL}
SELECT {_BY}, n, last_ts, last_value, {_STATUS} AS status, {_PHI} FROM phi"""


def _live_refits(spark: SparkSession, folder: str, lags: int, publish: str = "none") -> LiveRefit:
    path = scratch_path(spark, "refit")
    live = LiveRefit(f"{path}/tables", lags=lags, publish=publish, digits=4)
    live.start(event_stream(spark, folder), f"{path}/checkpoint").awaitTermination()
    return live


def stream_refit(spark: SparkSession, folder: str) -> DataFrame:
    """What live refits forecast, order 1."""
    return _live_refits(spark, folder, 1).forecasts(spark).drop("batch_id")


QUERIES["stream_refit"] = stream_refit
ORACLES["stream_refit"] = ORACLES["refit_forecasts"]


def stream_refit_order5(spark: SparkSession, folder: str) -> DataFrame:
    """What live refits forecast, full order; values where the model is well determined, of which the batch knows."""
    ahead = _live_refits(spark, folder, 5).forecasts(spark).drop("batch_id")
    known = refit_models(spark, folder).select("refit_arrival", "key", "status")
    value = F.when(F.col("status") == "ok", F.col("forecast"))
    return ahead.join(known, ["refit_arrival", "key"]).withColumn("forecast", value).select(
        "refit_arrival", "refit_ts", "key", "step", "ts", "forecast", "status"
    )


QUERIES["stream_refit_order5"] = stream_refit_order5
_STEPS_SQL = f"steps AS (SELECT unnest(generate_series(1, {ar.LIVE_HORIZON})) AS step)"
ORACLES["stream_refit_order5"] = f"""WITH {SNAPSHOT_SQL}, {_FULL_SQL}, {ar_forecast_sql(_BY, 5, ar.LIVE_HORIZON)},
models AS (SELECT {_BY}, last_ts, {_STATUS} AS status FROM phi), {_STEPS_SQL}
SELECT refit_arrival, refit_ts, key, CAST(s.step AS INTEGER) AS step, m.last_ts + to_minutes(CAST(s.step AS INTEGER)) AS ts,
    CASE WHEN status = 'ok' THEN round(a.forecast, 4) + 0.0 END AS forecast, status
FROM models m CROSS JOIN steps s LEFT JOIN ahead a USING (refit_arrival, refit_ts, key, step) WHERE status <> 'insufficient'"""


def _carried_models(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Models of live refits from carried state; coefficients where they are well determined."""
    path = scratch_path(spark, "carried")
    live = CarriedRefit(f"{path}/state")
    live.start(stream, f"{path}/checkpoint").awaitTermination()
    ok = F.col("status") == "ok"
    phi = [F.when(ok, F.round(F.col("phi")[i], 6) + F.lit(0.0)).alias(f"phi_{i + 1}") for i in range(5)]
    return live.models(spark).select("refit_arrival", "refit_ts", "key", "n", "last_ts", "last_value", "status", *phi)


def stream_carried_models(spark: SparkSession, folder: str) -> DataFrame:
    """Live refits of the full order that read closed blocks' sums instead of the history."""
    return _carried_models(spark, event_stream(spark, folder))


QUERIES["stream_carried_models"] = stream_carried_models
ORACLES["stream_carried_models"] = ORACLES["refit_models"]


def stream_carried_models_late(spark: SparkSession, folder: str) -> DataFrame:
    """The same where sign-ups arrive up to three days behind their time."""
    behind = F.make_dt_interval(F.lit(0), F.when(F.col("key") == "signup", F.col("entity") % 72).otherwise(0).cast("int"))
    stream = event_stream(spark, folder).withColumn("ts", F.col("ts") - behind)
    return _carried_models(spark, stream)


QUERIES["stream_carried_models_late"] = stream_carried_models_late
_BEHIND_SQL = """ev AS (SELECT event_id AS arrival, user_id AS entity, event_type AS key,
    ts - to_hours(CASE WHEN event_type = 'signup' THEN user_id % 72 ELSE 0 END) AS ts FROM events)"""
ORACLES["stream_carried_models_late"] = ORACLES["refit_models"].replace(EVENTS_SQL, _BEHIND_SQL)


def stream_live_path(spark: SparkSession, folder: str) -> DataFrame:
    """From JSON messages of three broker partitions to the forecasts of live refits, order 1."""
    wire = tables.events(spark, folder).select(
        "arrival",
        F.timestamp_seconds(F.col("arrival")).alias("timestamp"),
        (F.col("arrival") % 3).alias("partition"),
        F.floor(F.col("arrival") / 3).alias("offset"),
        F.to_json(F.struct(
            F.col("entity").cast("string").alias("Voter_id"),
            F.col("key").alias("Candidate_id"),
            F.date_format("ts", TIME_FORMAT).alias("Vote_Time"),
        )).alias("value"),
    )
    path = fed(spark, wire, "arrival", "wire")
    messages = stream_files(spark, path, wire.schema, "parquet", maxFilesPerTrigger=str(FILES)).drop("arrival")
    place = scratch_path(spark, "live-path")
    live = LiveRefit(f"{place}/tables", lags=1, publish="none", digits=4)
    live.start_messages(messages, f"{place}/checkpoint").awaitTermination()
    return live.forecasts(spark).drop("batch_id", "refit_arrival")


QUERIES["stream_live_path"] = stream_live_path
# Times on the wire are whole seconds.
_WIRE_SQL = "ev AS (SELECT event_id AS arrival, user_id AS entity, event_type AS key, date_trunc('second', ts) AS ts FROM events)"
ORACLES["stream_live_path"] = f"""{_one_lag_relations().replace(EVENTS_SQL, _WIRE_SQL)}
SELECT refit_ts, key, step, ts, round(forecast, 4) + 0.0 AS forecast FROM ahead
WHERE (refit_arrival, key) IN (SELECT (refit_arrival, key) FROM equations WHERE n > 0)"""


def latest_publication(spark: SparkSession, folder: str) -> DataFrame:
    """The points of each key's newest publication, from the messages of live refits written and read as text."""
    path = scratch_path(spark, "published")
    write_messages(_live_refits(spark, folder, 1, publish="newest").messages(spark), path)
    decoded = decode_json(spark.read.text(path), schemas.MESSAGE)
    return outlook.points_of(outlook.latest_publication(decoded)).drop("part", "parts")


QUERIES["latest_publication"] = latest_publication
ORACLES["latest_publication"] = f"""{_one_lag_relations()},
published AS (SELECT DISTINCT refit_arrival, key FROM equations WHERE n > 0),
newest AS (SELECT key, max(refit_arrival) AS refit_arrival FROM published GROUP BY key)
SELECT refit_arrival AS publication, key AS candidate_id, 'history' AS kind,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, CAST(total AS DOUBLE) AS votes FROM snapshots JOIN newest USING (refit_arrival, key)
UNION ALL SELECT refit_arrival, key, 'forecast', strftime(ts, '%Y-%m-%d %H:%M:%S'), round(forecast, 4) + 0.0
FROM ahead JOIN newest USING (refit_arrival, key)"""
