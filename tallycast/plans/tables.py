"""The given tables as event-count inputs, with the SQL text of the same views."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.functions.times import TIME_FORMAT
from tallycast.operators.lookup import first_per_entity, join_dimension, reference_embeddings
from tallycast.session import ship

# Key dimension: three of the event types take part, in this order.
KEY_RANKS = [("click", 1, "Candidate 1"), ("purchase", 2, "Candidate 2"), ("view", 3, "Candidate 3")]


_KEY_VALUES = ", ".join(f"('{key}', {rank}, '{label}')" for key, rank, label in KEY_RANKS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events in arrival order: the event number grows as events arrive."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("arrival"), F.col("user_id").alias("entity"), F.col("event_type").alias("key"), "ts"
    )


EVENTS_SQL = "ev AS (SELECT event_id AS arrival, user_id AS entity, event_type AS key, ts FROM events)"


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a second, larger source of events: keyed by their two flags, timed by the day shipped."""
    return table(spark, folder, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("key"), F.col("l_shipdate").alias("ts")
    )


SHIPMENTS_SQL = "ship AS (SELECT l_returnflag || l_linestatus AS key, l_shipdate AS ts FROM lineitem)"


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with their time as text. Error events come from a writer that does not pad the hour,
    and sign-ups from one that puts the day first, so part of their times does not parse."""
    padded = F.date_format("ts", TIME_FORMAT)
    short_hour = F.date_format("ts", "yyyy-MM-dd H:mm:ss")
    day_first = F.date_format("ts", "yyyy-dd-MM HH:mm:ss")
    text = F.when(F.col("key") == "error", short_hour).when(F.col("key") == "signup", day_first).otherwise(padded)
    return events(spark, folder).select("arrival", "entity", "key", text.alias("event_time"))


RAW_SQL = EVENTS_SQL + """,
raw AS (SELECT arrival, entity, key, CASE
    WHEN key = 'error' THEN strftime(ts, '%Y-%m-%d ') || hour(ts) || strftime(ts, ':%M:%S')
    WHEN key = 'signup' THEN strftime(ts, '%Y-%d-%m %H:%M:%S')
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_time FROM ev),
parsed AS (SELECT *, CASE WHEN regexp_full_match(event_time, '\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}')
    THEN try_strptime(event_time, '%Y-%m-%d %H:%M:%S') END AS ts FROM raw)"""


def key_dimension(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES " + _KEY_VALUES + " AS t(key, rank, label)")


KEYS_SQL = f"keys(key, rank, label) AS (VALUES {_KEY_VALUES})"


def registered(spark: SparkSession, folder: str) -> DataFrame:
    """Entities with a registered picture; those of one market segment never registered."""
    customers = table(spark, folder, "customer").filter(F.col("c_mktsegment") != "MACHINERY")
    named = customers.select(F.col("c_custkey").alias("entity"), F.col("c_name").alias("name"))
    return first_per_entity(named, "entity")


REGISTERED_SQL = (
    "registered AS (SELECT c_custkey AS entity, min(c_name) AS name FROM customer "
    "WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1)"
)


def references(spark: SparkSession, folder: str) -> DataFrame:
    """Registered embeddings by entity."""
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("entity"), "embedding")
    known = vectors.join(registered(spark, folder).select("entity"), "entity", "left_semi")
    return reference_embeddings(known, "entity")


def live_events(events: DataFrame, source: DataFrame, small: bool | None = None) -> DataFrame:
    """Events with their live embedding: clicks and views show the entity itself, purchases and
    sign-ups the face numbered in the event's properties, and in error events no face is found."""
    return join_dimension(shown_faces(events), _live_vectors(source), "face", small=small)


def shown_faces(events: DataFrame) -> DataFrame:
    """Events with the number of the face that was shown."""
    own = F.col("key").isin("click", "view")
    other = F.col("key").isin("purchase", "signup")
    shown = F.when(own, F.col("entity")).when(other, F.get_json_object("props", "$.k").cast("bigint"))
    return events.withColumn("face", shown)


def _live_vectors(source: DataFrame) -> DataFrame:
    return reference_embeddings(source, "vec_id").withColumnsRenamed(
        {"entity": "face", "reference": "live", "reference_norm": "live_norm"}
    )


def faces(spark: SparkSession, folder: str) -> DataFrame:
    """All live embeddings by face, with their norms."""
    return _live_vectors(table(spark, folder, "embeddings"))


FACES_SQL = """faces AS (SELECT event_id AS arrival, user_id AS entity, event_type AS key, CASE
    WHEN event_type IN ('click', 'view') THEN user_id
    WHEN event_type IN ('purchase', 'signup') THEN CAST(props ->> 'k' AS BIGINT) END AS face FROM events),
""" + REGISTERED_SQL + """,
checked AS (SELECT f.arrival, f.entity, f.key, r.vec_id IS NOT NULL AS has_reference,
    list_cosine_similarity(CAST(l.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) AS similarity
    FROM faces f
    LEFT JOIN (SELECT vec_id, embedding FROM embeddings WHERE vec_id IN (SELECT entity FROM registered)) r
        ON r.vec_id = f.entity
    LEFT JOIN embeddings l ON l.vec_id = f.face),
verdicts AS (SELECT *, CASE WHEN NOT has_reference THEN 'no_reference' WHEN similarity IS NULL THEN 'not_detected'
    WHEN similarity >= 0.7 THEN 'match' ELSE 'mismatch' END AS verdict FROM checked)"""
