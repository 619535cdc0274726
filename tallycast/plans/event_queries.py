"""Queries over events: cleaning, slots, lookups, verification. Each with its SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.operators import cleaning, lookup, outlook, slots
from tallycast.plans import tables
from tallycast.plans.tables import EVENTS_SQL, FACES_SQL, KEYS_SQL, RAW_SQL, REGISTERED_SQL
from tallycast.session import scratch_path
from tallycast.sources.readers import read_events_csv
from tallycast.sources.writers import append_csv

SLOTS_SQL = EVENTS_SQL + """,
slot AS (SELECT CAST(hour(ts) AS INT) AS hour, CAST(minute(ts) AS INT) AS minute, key, count(*) AS votes
    FROM ev GROUP BY 1, 2, 3),
cumulative AS (SELECT *, CAST(sum(votes) OVER (PARTITION BY key ORDER BY hour, minute) AS BIGINT) AS cumulative_votes
    FROM slot)"""

QUERIES = {}
ORACLES = {}


def clean_events(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_events(tables.raw_events(spark, folder))


QUERIES["clean_events"] = clean_events
ORACLES["clean_events"] = f"WITH {RAW_SQL} SELECT arrival, entity, key, ts FROM parsed WHERE ts IS NOT NULL"


def csv_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events appended to header-less CSV files, read back by position, cleaned and counted per slot."""
    path = scratch_path(spark, "csv")
    append_csv(tables.raw_events(spark, folder).select("entity", "key", "event_time"), path)
    return slots.slot_counts(cleaning.clean_events(read_events_csv(spark, path)))


QUERIES["csv_events"] = csv_events
ORACLES["csv_events"] = f"""WITH {RAW_SQL}
SELECT CAST(hour(ts) AS INT) AS hour, CAST(minute(ts) AS INT) AS minute, key, count(*) AS votes
FROM parsed WHERE ts IS NOT NULL GROUP BY 1, 2, 3"""


def rejected_events(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.rejected_events(tables.raw_events(spark, folder))


QUERIES["rejected_events"] = rejected_events
ORACLES["rejected_events"] = f"WITH {RAW_SQL} SELECT arrival, entity, key, event_time FROM parsed WHERE ts IS NULL"


def slot_counts(spark: SparkSession, folder: str) -> DataFrame:
    return slots.slot_counts(tables.events(spark, folder))


QUERIES["slot_counts"] = slot_counts
ORACLES["slot_counts"] = f"WITH {SLOTS_SQL} SELECT hour, minute, key, votes FROM slot"


def slot_counts_all(spark: SparkSession, folder: str) -> DataFrame:
    return slots.slot_counts_all(tables.events(spark, folder))


QUERIES["slot_counts_all"] = slot_counts_all
ORACLES["slot_counts_all"] = (
    f"WITH {SLOTS_SQL} SELECT hour, minute, CAST(sum(votes) AS BIGINT) AS votes FROM slot GROUP BY 1, 2"
)


def cumulative_slots(spark: SparkSession, folder: str) -> DataFrame:
    return slots.cumulative_slots(tables.events(spark, folder))


QUERIES["cumulative_slots"] = cumulative_slots
ORACLES["cumulative_slots"] = f"WITH {SLOTS_SQL} SELECT * FROM cumulative"


def cumulative_minutes(spark: SparkSession, folder: str) -> DataFrame:
    return slots.cumulative_slots(tables.events(spark, folder), slot="minute")


QUERIES["cumulative_minutes"] = cumulative_minutes
ORACLES["cumulative_minutes"] = f"""WITH {EVENTS_SQL},
slot AS (SELECT key, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS ts, count(*) AS votes FROM ev GROUP BY 1, 2)
SELECT key, votes, CAST(sum(votes) OVER (PARTITION BY key ORDER BY ts) AS BIGINT) AS cumulative_votes, ts FROM slot"""


def slot_time_series(spark: SparkSession, folder: str) -> DataFrame:
    return slots.slot_time_series(cumulative_slots(spark, folder)).select("key", "clock", "slot_ts", "cumulative_votes")


QUERIES["slot_time_series"] = slot_time_series
ORACLES["slot_time_series"] = f"""WITH {SLOTS_SQL}
SELECT key, printf('%02d:%02d:00', hour, minute) AS clock, cumulative_votes,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(hour * 60 + minute) AS slot_ts
FROM cumulative"""


def distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.distinct_keys(tables.events(spark, folder))


QUERIES["distinct_keys"] = distinct_keys
ORACLES["distinct_keys"] = f"WITH {EVENTS_SQL} SELECT DISTINCT key FROM ev"


def first_n_events(spark: SparkSession, folder: str) -> DataFrame:
    """Bounded emission: the limit is the feature."""
    return cleaning.first_events(tables.events(spark, folder))


QUERIES["first_n_events"] = first_n_events
ORACLES["first_n_events"] = f"WITH {EVENTS_SQL} SELECT arrival, entity, key, ts FROM ev ORDER BY arrival LIMIT 1201"


def entity_lookup(spark: SparkSession, folder: str) -> DataFrame:
    found = lookup.entity_lookup(tables.events(spark, folder), tables.registered(spark, folder))
    return found.select("arrival", "entity", "name")


QUERIES["entity_lookup"] = entity_lookup
ORACLES["entity_lookup"] = f"""WITH {EVENTS_SQL}, {REGISTERED_SQL}
SELECT arrival, ev.entity, name FROM ev LEFT JOIN registered USING (entity)"""


def entity_lookup_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The lookup in a dimension too large to go to every task."""
    found = lookup.entity_lookup(tables.events(spark, folder), tables.registered(spark, folder), small=False)
    return found.select("arrival", "entity", "name")


QUERIES["entity_lookup_shuffled"] = entity_lookup_shuffled
ORACLES["entity_lookup_shuffled"] = ORACLES["entity_lookup"]


def known_events(spark: SparkSession, folder: str) -> DataFrame:
    known = cleaning.known_events(tables.events(spark, folder), tables.key_dimension(spark))
    return known.select("arrival", "key", "label", "rank")


QUERIES["known_events"] = known_events
ORACLES["known_events"] = f"WITH {EVENTS_SQL}, {KEYS_SQL} SELECT arrival, key, label, rank FROM ev JOIN keys USING (key)"


def unknown_events(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.unknown_events(tables.events(spark, folder), tables.key_dimension(spark)).select("arrival", "key")


QUERIES["unknown_events"] = unknown_events
ORACLES["unknown_events"] = (
    f"WITH {EVENTS_SQL}, {KEYS_SQL} SELECT arrival, key FROM ev WHERE key NOT IN (SELECT key FROM keys)"
)


def json_props(spark: SparkSession, folder: str) -> DataFrame:
    """One property that is there and one that never is."""
    events = tables.table(spark, folder, "events")
    fields = cleaning.json_field(events, "props", "k bigint, source string", {"k": -1, "source": "Unknown"})
    return fields.select("event_id", "k", "source")


QUERIES["json_props"] = json_props
ORACLES["json_props"] = """SELECT event_id, coalesce(CAST(props ->> 'k' AS BIGINT), -1) AS k,
    coalesce(props ->> 'source', 'Unknown') AS source FROM events"""


def _verified(spark: SparkSession, folder: str, small: bool | None = None) -> DataFrame:
    events = tables.table(spark, folder, "events").select(
        F.col("event_id").alias("arrival"), F.col("user_id").alias("entity"), F.col("event_type").alias("key"), "props"
    )
    live = tables.live_events(events, tables.table(spark, folder, "embeddings"), small)
    return lookup.verify(live, tables.references(spark, folder), "live", F.col("live_norm"), small=small)


def embedding_similarity(spark: SparkSession, folder: str) -> DataFrame:
    return _verified(spark, folder).select("arrival", F.round("similarity", 6).alias("similarity"))


QUERIES["embedding_similarity"] = embedding_similarity
ORACLES["embedding_similarity"] = f"WITH {FACES_SQL} SELECT arrival, round(similarity, 6) + 0.0 AS similarity FROM checked"


def verify_events(spark: SparkSession, folder: str) -> DataFrame:
    return _verified(spark, folder).select("arrival", "entity", "key", "verdict")


QUERIES["verify_events"] = verify_events
ORACLES["verify_events"] = f"WITH {FACES_SQL} SELECT arrival, entity, key, verdict FROM verdicts"


def verify_events_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The verdicts with more embeddings than go to every task."""
    return _verified(spark, folder, small=False).select("arrival", "entity", "key", "verdict")


QUERIES["verify_events_shuffled"] = verify_events_shuffled
ORACLES["verify_events_shuffled"] = ORACLES["verify_events"]


def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    return outlook.latest_per_key(tables.events(spark, folder), offset="arrival")


QUERIES["latest_per_key"] = latest_per_key
ORACLES["latest_per_key"] = f"""WITH {EVENTS_SQL}
SELECT key, arrival, entity, ts FROM ev WHERE arrival IN (SELECT max(arrival) FROM ev GROUP BY key)"""
