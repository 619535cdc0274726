"""Explicit schemas; nothing is inferred from the data."""

from pyspark.sql import types as T

# Raw event record: positional text columns.
RAW_EVENT = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("event_time", T.StringType()),
])

# Live event message. Fixed field names of the wire format.
LIVE_EVENT = T.StructType([
    T.StructField("Voter_id", T.StringType()),
    T.StructField("Candidate_id", T.StringType()),
    T.StructField("Vote_Time", T.StringType()),
    T.StructField("Voter_image", T.StringType()),
])

# Key dimension. Fixed column names of the file, all text.
KEY_DIMENSION = T.StructType([T.StructField(name, T.StringType()) for name in (
    "Candidate_id", "Gender", "Title", "First Name", "Last Name", "party_affiliation", "Picture",
)])

MINUTE_SERIES = T.StructType([
    T.StructField("vote_time", T.TimestampNTZType()),
    T.StructField("cumulative_votes", T.DoubleType()),
])

FORECAST = T.StructType([
    T.StructField("candidate_id", T.StringType()),
    T.StructField("minute", T.IntegerType()),
    T.StructField("forecast", T.DoubleType()),
])

# Published message. Fixed field names of the wire format, plus the publication it belongs to and the
# part number that keeps one message bounded when a history is long.
MESSAGE = T.StructType([
    T.StructField("candidate_id", T.StringType()),
    T.StructField("publication", T.LongType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("parts", T.IntegerType()),
    T.StructField("forecast", T.ArrayType(T.StructType([
        T.StructField("time", T.StringType()),
        T.StructField("votes", T.DoubleType()),
    ]))),
    T.StructField("historical_data", T.ArrayType(T.StructType([
        T.StructField("vote_time", T.StringType()),
        T.StructField("cumulative_votes", T.DoubleType()),
    ]))),
])
