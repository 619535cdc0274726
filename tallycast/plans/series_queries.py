"""Queries over series: running totals, minute grids, triggers, charts. Each with its SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast import schemas
from tallycast.operators import charts, series, triggers
from tallycast.plans import tables
from tallycast.plans.event_queries import SLOTS_SQL, cumulative_slots, slot_counts_all
from tallycast.plans.tables import EVENTS_SQL
from tallycast.session import materialize, scratch_path
from tallycast.sources.readers import read_per_key_csv
from tallycast.sources.writers import write_per_key_csv

RUNNING_SQL = EVENTS_SQL + """,
running AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY arrival) AS running_total FROM ev)"""

MINUTES_SQL = RUNNING_SQL + """,
seen AS (SELECT key, CAST(date_trunc('minute', r.ts) AS TIMESTAMP) AS ts,
    last(running_total ORDER BY r.ts, arrival) AS total FROM running r GROUP BY 1, 2),
grid AS (SELECT key, unnest(generate_series(min(ts), max(ts), INTERVAL 1 MINUTE)) AS ts FROM seen GROUP BY key),
minutes AS (SELECT key, ts, last_value(total IGNORE NULLS) OVER (PARTITION BY key ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM grid LEFT JOIN seen USING (key, ts))"""

TRIGGERS_SQL = EVENTS_SQL + """,
candidate AS (SELECT arrival, ts, lag(hour(ts)) OVER (ORDER BY arrival) AS previous FROM ev
    WHERE minute(ts) = 0 AND hour(ts) <> 8),
trigger_at AS (SELECT arrival, ts FROM candidate WHERE previous IS NULL OR previous <> hour(ts))"""

QUERIES = {}
ORACLES = {}


def running_totals(spark: SparkSession, folder: str) -> DataFrame:
    return series.running_totals(tables.events(spark, folder)).select("arrival", "key", "running_total")


QUERIES["running_totals"] = running_totals
ORACLES["running_totals"] = f"WITH {RUNNING_SQL} SELECT arrival, key, running_total FROM running"


def minute_series(spark: SparkSession, folder: str) -> DataFrame:
    return series.minute_series(tables.events(spark, folder))


QUERIES["minute_series"] = minute_series
ORACLES["minute_series"] = f"WITH {MINUTES_SQL} SELECT key, ts, total FROM minutes"


def monotonic_check(spark: SparkSession, folder: str) -> DataFrame:
    return series.monotonic_check(minute_series(spark, folder))


QUERIES["monotonic_check"] = monotonic_check
ORACLES["monotonic_check"] = f"""WITH {MINUTES_SQL},
steps AS (SELECT key, total < lag(total) OVER (PARTITION BY key ORDER BY ts) AS dropped FROM minutes)
SELECT key, count(*) AS points, bool_or(coalesce(dropped, false)) AS decreases FROM steps GROUP BY key"""


def late_minute_series(spark: SparkSession, folder: str) -> DataFrame:
    """Events that arrive in the order of their users, so that event times are far out of order."""
    events = tables.events(spark, folder)
    events = events.withColumn("arrival", F.col("entity") * 2**32 + F.col("arrival"))
    return series.minute_series(events)


QUERIES["late_minute_series"] = late_minute_series
ORACLES["late_minute_series"] = "WITH " + MINUTES_SQL.replace(
    "SELECT event_id AS arrival", "SELECT user_id * 4294967296 + event_id AS arrival"
) + " SELECT key, ts, total FROM minutes"


def last_seen(spark: SparkSession, folder: str) -> DataFrame:
    return series.last_seen(tables.events(spark, folder))


QUERIES["last_seen"] = last_seen
ORACLES["last_seen"] = f"WITH {EVENTS_SQL} SELECT key, max(ts) AS last_ts FROM ev GROUP BY key"


def trigger_points(spark: SparkSession, folder: str) -> DataFrame:
    return triggers.trigger_points(tables.events(spark, folder))


QUERIES["trigger_points"] = trigger_points
ORACLES["trigger_points"] = f"WITH {TRIGGERS_SQL} SELECT arrival, ts FROM trigger_at"


def snapshot_totals(spark: SparkSession, folder: str) -> DataFrame:
    points = materialize(trigger_points(spark, folder), "triggers")
    return triggers.snapshot_totals(tables.events(spark, folder), points)


QUERIES["snapshot_totals"] = snapshot_totals
ORACLES["snapshot_totals"] = f"""WITH {TRIGGERS_SQL}
SELECT t.arrival, t.ts, ev.key, count(*) FILTER (ev.arrival <= t.arrival) AS total
FROM trigger_at t, ev GROUP BY 1, 2, 3"""


def snapshot_totals_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The same for a trigger list too long to go to every task."""
    points = materialize(trigger_points(spark, folder), "triggers")
    return triggers.snapshot_totals(tables.events(spark, folder), points, listed=0)


QUERIES["snapshot_totals_merged"] = snapshot_totals_merged
ORACLES["snapshot_totals_merged"] = ORACLES["snapshot_totals"]


def key_from_path(spark: SparkSession, folder: str) -> DataFrame:
    """The minute series written as one CSV folder per key and read back, the key taken from the path."""
    path = scratch_path(spark, "per-key")
    wire = minute_series(spark, folder).select(
        "key", F.col("ts").alias("vote_time"), F.col("total").cast("double").alias("cumulative_votes")
    )
    write_per_key_csv(wire, path)
    return read_per_key_csv(spark, path + "/key=*", schemas.MINUTE_SERIES)


QUERIES["key_from_path"] = key_from_path
ORACLES["key_from_path"] = f"""WITH {MINUTES_SQL}
SELECT key, ts AS vote_time, CAST(total AS DOUBLE) AS cumulative_votes FROM minutes"""


def heatmap_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return charts.heatmap_pivot(cumulative_slots(spark, folder), "cumulative_votes", "key")


QUERIES["heatmap_pivot"] = heatmap_pivot
ORACLES["heatmap_pivot"] = f"WITH {SLOTS_SQL} SELECT key, hour, " + ", ".join(
    f"CAST(sum(cumulative_votes) FILTER (minute = {m}) AS BIGINT) AS m{m}" for m in range(60)
) + " FROM cumulative GROUP BY 1, 2"


def box_stats(spark: SparkSession, folder: str) -> DataFrame:
    boxes = charts.box_stats(cumulative_slots(spark, folder), "votes")
    return boxes.withColumn("n_outliers", F.size("outliers").cast("bigint")).drop("outliers")


BOX_SQL = SLOTS_SQL + """,
quart AS (SELECT key, hour, quantile_cont(CAST(votes AS DOUBLE), 0.25) AS q1,
    quantile_cont(CAST(votes AS DOUBLE), 0.5) AS median,
    quantile_cont(CAST(votes AS DOUBLE), 0.75) AS q3 FROM cumulative GROUP BY 1, 2),
placed AS (SELECT c.key, c.hour, CAST(votes AS DOUBLE) AS v, q1, median, q3,
    votes BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM cumulative c JOIN quart USING (key, hour)),
hours AS (SELECT key, CAST(unnest(range(24)) AS INT) AS hour FROM (SELECT DISTINCT key FROM cumulative))"""

QUERIES["box_stats"] = box_stats
ORACLES["box_stats"] = f"""WITH {BOX_SQL}
SELECT key, hour, count(v) AS n, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
    min(v) FILTER (inside) AS whisker_low, max(v) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS n_outliers
FROM hours LEFT JOIN placed USING (key, hour) GROUP BY key, hour"""


def box_outliers(spark: SparkSession, folder: str) -> DataFrame:
    boxes = charts.box_stats(cumulative_slots(spark, folder), "votes")
    return boxes.select("key", "hour", F.explode("outliers").alias("outlier"))


QUERIES["box_outliers"] = box_outliers
ORACLES["box_outliers"] = f"WITH {BOX_SQL} SELECT key, hour, v AS outlier FROM placed WHERE NOT inside"


def hour_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return charts.hour_histogram(slot_counts_all(spark, folder)).select("bin", F.round("bin_start", 6).alias("bin_start"), "n")


QUERIES["hour_histogram"] = hour_histogram
ORACLES["hour_histogram"] = f"""WITH {SLOTS_SQL},
every AS (SELECT DISTINCT hour, minute FROM slot),
ends AS (SELECT min(hour) AS lo, max(hour) AS hi FROM every),
put AS (SELECT least(CAST(floor((hour - lo) * 24.0 / (hi - lo)) AS INT) + 1, 24) AS bin FROM every, ends),
bins AS (SELECT CAST(unnest(range(1, 25)) AS INT) AS bin)
SELECT bin, round(lo + (bin - 1) * (hi - lo) / 24.0, 6) AS bin_start,
    (SELECT count(*) FROM put WHERE put.bin = bins.bin) AS n FROM bins, ends"""
