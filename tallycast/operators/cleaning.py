"""Raw records to clean events."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.functions.times import parse_time
from tallycast.operators.lookup import join_dimension


def parse_events(raw: DataFrame, time: str = "event_time", out: str = "ts") -> DataFrame:
    """Replace the time text by a timestamp, null when it does not parse."""
    return raw.withColumn(out, parse_time(F.col(time)))


def clean_events(raw: DataFrame, time: str = "event_time", out: str = "ts") -> DataFrame:
    """Records whose time parses. Duplicates and unknown keys stay: they count."""
    return parse_events(raw, time, out).filter(F.col(out).isNotNull()).drop(time)


def rejected_events(raw: DataFrame, time: str = "event_time") -> DataFrame:
    """The complement of ``clean_events``, with the original text."""
    return raw.filter(parse_time(F.col(time)).isNull())


def known_events(events: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Events whose key is in the key dimension, with that dimension's other columns (label, rank)."""
    return join_dimension(events, keys, key, "inner")


def unknown_events(events: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Events whose key is missing from the key dimension (null keys included)."""
    return join_dimension(events, keys.select(key), key, "left_anti")


def json_field(events: DataFrame, text: str, schema: str, defaults: dict[str, object]) -> DataFrame:
    """Read JSON fields, each with the default that stands in for a missing or malformed value."""
    parsed = F.from_json(F.col(text), schema)
    fields = {name: F.coalesce(parsed[name], F.lit(default)) for name, default in defaults.items()}
    return events.withColumns(fields)


def distinct_keys(events: DataFrame, key: str = "key") -> DataFrame:
    return events.select(key).distinct()


def first_events(events: DataFrame, n: int = 1201, arrival: str = "arrival") -> DataFrame:
    """The first ``n`` events to arrive; the fixed default is one simulated hour at 3 s steps."""
    return events.orderBy(arrival).limit(n)
