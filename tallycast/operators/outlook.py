"""What is shown and published from histories and forecasts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.functions.times import TIME_FORMAT, epoch_minute

POINTS_PER_MESSAGE = 1440  # one day of minutes


def history_and_forecast(history: DataFrame, forecast: DataFrame, key: str = "key", value: str = "total") -> DataFrame:
    """Both on one time axis, told apart by ``kind``."""
    past = history.select(key, F.lit("history").alias("kind"), "ts", F.col(value).cast("double").alias("votes"))
    ahead = forecast.select(key, F.lit("forecast").alias("kind"), "ts", F.col("forecast").alias("votes"))
    return past.unionByName(ahead)


def last_forecast(forecast: DataFrame, key: str = "key") -> DataFrame:
    return forecast.groupBy(key).agg(F.max_by("forecast", "step").alias("last_forecast"))


def projected_winner(forecast: DataFrame, keys: DataFrame | None = None, key: str = "key") -> DataFrame:
    """The key with the largest last forecast, truncated to whole votes.

    Ties go to the smaller rank of the key dimension, or to the smaller key without one. Keys
    without a forecast do not take part.
    """
    last = last_forecast(forecast, key)
    ranked = last.join(keys.select(key, "rank"), key) if keys is not None else last.withColumn("rank", F.lit(0))
    top = ranked.orderBy(F.col("last_forecast").desc(), "rank", key).limit(1)
    return top.select(key, F.col("last_forecast").cast("bigint").alias("votes"))


def publish_messages(
    history: DataFrame,
    forecast: DataFrame,
    key: str = "key",
    value: str = "total",
    points: int = POINTS_PER_MESSAGE,
    publication: str = "publication",
) -> DataFrame:
    """JSON messages ``(key, publication, part, parts, value)`` holding a key's history and forecast.

    ``publication`` numbers what is published together (a refit's arrival); it is 0 where the inputs have no such
    column. A history is cut into parts of ``points`` minutes, nothing is left out, and the forecast rides in the last
    part; so no group that is collected into an array exceeds ``points`` entries. Every body names its publication,
    part and number of parts, whatever the length. Keys without a forecast publish nothing; a null key is a key.
    """
    numbered = lambda df: df if publication in df.columns else df.withColumn(publication, F.lit(0).cast("bigint"))
    history, forecast = numbered(history), numbered(forecast)
    same = lambda other: F.col(key).eqNullSafe(other[f"_{key}"]) & (F.col(publication) == other[f"_{publication}"])
    keyed = lambda df: df.withColumnsRenamed({key: f"_{key}", publication: f"_{publication}"})
    minute = epoch_minute(F.col("ts"))
    ahead = keyed(forecast.groupBy(key, publication).agg(
        F.sort_array(F.collect_list(F.struct(
            F.date_format("ts", TIME_FORMAT).alias("time"), F.col("forecast").alias("votes"),
        ))).alias("forecast")
    ))
    spans = keyed(history.groupBy(key, publication).agg(F.min(minute).alias("_first"), F.max(minute).alias("_last")))
    parts = history.join(spans, same(spans)).groupBy(
        key,
        publication,
        F.floor((minute - F.col("_first")) / points).cast("int").alias("part"),
        (F.floor((F.col("_last") - F.col("_first")) / points) + 1).cast("int").alias("parts"),
    ).agg(
        F.sort_array(F.collect_list(F.struct(
            F.date_format("ts", TIME_FORMAT).alias("vote_time"),
            F.col(value).cast("double").alias("cumulative_votes"),
        ))).alias("historical_data")
    )
    no_steps = F.array().cast("array<struct<time:string,votes:double>>")
    ahead_here = F.when(F.col("part") == F.col("parts") - 1, F.col("forecast")).otherwise(no_steps)
    body = F.struct(
        F.col(key).alias("candidate_id"),
        F.col(publication).alias("publication"),
        "part",
        "parts",
        ahead_here.alias("forecast"),
        "historical_data",
    )
    return parts.join(ahead, same(ahead)).select(
        key, F.col(publication).alias("publication"), "part", "parts", F.to_json(body).alias("value")
    )


def latest_publication(decoded: DataFrame, key: str = "candidate_id") -> DataFrame:
    """All parts of each key's newest publication, from decoded messages."""
    newest = decoded.groupBy(F.col(key).alias("_key")).agg(F.max("publication").alias("_newest"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("publication") == F.col("_newest"))
    return decoded.join(newest, same, "left_semi")


def points_of(decoded: DataFrame) -> DataFrame:
    """Decoded messages as one row per point: publication, part, parts, candidate_id, kind, time, votes."""
    shared = ["publication", "part", "parts", "candidate_id"]
    past = decoded.select(*shared, F.lit("history").alias("kind"), F.explode("historical_data").alias("p"))
    ahead = decoded.select(*shared, F.lit("forecast").alias("kind"), F.explode("forecast").alias("p"))
    return past.select(*shared, "kind", F.col("p.vote_time").alias("time"), F.col("p.cumulative_votes").alias("votes")).unionByName(
        ahead.select(*shared, "kind", "p.time", "p.votes")
    )


def stamp_forecast(forecast: DataFrame, last: DataFrame, key: str = "key", step: str = "minute") -> DataFrame:
    """A stored forecast, numbered in minutes, with the times that follow each key's ``last_ts``; a key without one has null times."""
    ends = last.select(F.col(key).alias("_key"), "last_ts")
    zero = F.lit(0)
    ahead = F.make_dt_interval(zero, zero, F.col(step), zero)
    stamped = forecast.join(ends, F.col(key).eqNullSafe(F.col("_key")), "left")
    return stamped.withColumn("ts", F.col("last_ts") + ahead).drop("_key", "last_ts")


def latest_per_key(messages: DataFrame, key: str = "key", offset: str = "offset") -> DataFrame:
    """The newest message of each key replaces the earlier ones."""
    rest = [c for c in messages.columns if c != key]
    newest = messages.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(offset)).alias("_newest"))
    return newest.select(key, *[F.col("_newest")[c].alias(c) for c in rest])
