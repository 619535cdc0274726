"""Live refits: totals, triggers and forecasts from micro-batches of events."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallycast.operators import autoregression as ar
from tallycast.operators.cleaning import clean_events, rejected_events
from tallycast.operators.outlook import publish_messages
from tallycast.operators.refit import history_parts, refit_histories, refit_models
from tallycast.operators.triggers import candidate_changes, trigger_points
from tallycast.session import materialize, scratch_scope
from tallycast.sources.readers import live_events
from tallycast.streaming.arrivals import BROKER_ORDER, numbered_arrivals
from tallycast.streaming.sinks import read_batches

MARK = "arrival bigint, ts timestamp_ntz"
TOTALS = "key string, so_far bigint"
PUBLISHED = (
    "refit_arrival bigint, refit_ts timestamp_ntz, key string, step int, ts timestamp_ntz, forecast double"
)
MESSAGES = "key string, publication bigint, part int, parts int, value string"


class LiveRefit:
    """Keeps five tables below ``folder``, one sub-folder per micro-batch each:

    ``mark`` (the newest candidate so far), ``totals`` (count per key so far), ``parts`` (the
    history by key and minute), ``forecasts`` (every refit's steps) and ``messages`` (what each refit
    publishes: per key its history as of the trigger and the steps, in parts; the publication is numbered by the
    trigger's arrival). ``publish`` is "all" refits, the "newest" of each micro-batch, or "none". A batch reads the
    mark and totals of the batch before it, and the history only when a refit fires, so an ordinary
    batch costs the same however long the stream has run; its events are never read again. It
    replaces its own sub-folders, so a replay after a failure repeats nothing. Later batches
    must carry larger arrival numbers, as offsets do.
    """

    def __init__(
        self, folder: str, lags: int = ar.LAGS, horizon: int = ar.LIVE_HORIZON, publish: str = "all", digits: int | None = None
    ):
        self.folder, self.lags, self.horizon, self.publish, self.digits = folder, lags, horizon, publish, digits

    def _replace(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch_id={batch_id}")

    def _previous(self, spark: SparkSession, name: str, schema: str, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.folder}/{name}/batch_id={batch_id - 1}")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch; its scratch tables are removed at the end, also after a failure."""
        with scratch_scope(batch.sparkSession):
            self._process(batch, batch_id)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events = materialize(batch.select("key", "ts", "arrival"), "batch")

        changes = materialize(candidate_changes(events), "changes")
        candidates = self._previous(spark, "mark", MARK, batch_id).unionByName(changes)
        triggers = materialize(trigger_points(candidates).join(changes.select("arrival"), "arrival", "left_semi"), "triggers")
        newest = candidates.agg(F.max_by(F.struct("arrival", "ts"), "arrival").alias("_newest"))
        self._replace(newest.select("_newest.*").filter("arrival IS NOT NULL"), "mark", batch_id)

        parts = history_parts(events, triggers).drop("interval")
        totals = self._previous(spark, "totals", TOTALS, batch_id)
        before = totals.select(F.col("key").alias("_key"), "so_far")
        shifted = parts.join(before, F.col("key").eqNullSafe(F.col("_key")), "left").withColumn(
            "total", F.col("total") + F.coalesce("so_far", F.lit(0))
        )
        self._replace(shifted.select(parts.columns), "parts", batch_id)
        added = parts.groupBy("key").agg(F.sum("n").alias("so_far"))
        self._replace(totals.unionByName(added).groupBy("key").agg(F.sum("so_far").alias("so_far")), "totals", batch_id)

        if triggers.isEmpty():
            self._replace(spark.createDataFrame([], PUBLISHED), "forecasts", batch_id)
            self._replace(spark.createDataFrame([], MESSAGES), "messages", batch_id)
            return
        history = read_batches(spark, f"{self.folder}/parts", parts.schema).filter(F.col("batch_id") <= batch_id)
        history = materialize(history.drop("batch_id"), "history")
        ahead = ar.forecast(refit_models(history, triggers, self.lags), self.horizon, ["refit_arrival", "refit_ts", "key"])
        if self.digits is not None:
            ahead = ahead.withColumn("forecast", F.round("forecast", self.digits) + F.lit(0.0))
        self._replace(ahead, "forecasts", batch_id)
        messages = spark.createDataFrame([], MESSAGES)
        if self.publish != "none":
            shown = triggers if self.publish == "all" else triggers.orderBy(F.col("arrival").desc()).limit(1)
            shown = materialize(shown, "shown")
            seen = refit_histories(history, shown).withColumnRenamed("refit_arrival", "publication")
            steps = spark.read.schema(PUBLISHED).parquet(f"{self.folder}/forecasts/batch_id={batch_id}")
            steps = steps.join(shown.select(F.col("arrival").alias("refit_arrival")), "refit_arrival", "left_semi")
            messages = publish_messages(seen, steps.withColumnRenamed("refit_arrival", "publication"))
        self._replace(messages, "messages", batch_id)

    def process_messages(self, batch: DataFrame, batch_id: int, order: Sequence[str] = BROKER_ORDER) -> None:
        """One micro-batch of JSON messages, with the columns ``order`` that rank them.

        Messages whose time doesn't parse go to the table ``rejected`` with their text; the others get arrival numbers
        and are processed as events.
        """
        with scratch_scope(batch.sparkSession):
            raw = materialize(live_events(batch.withColumn("_text", F.col("value").cast("string"))), "messages")
            self._replace(rejected_events(raw).select(*order, F.col("_text").alias("value")), "rejected", batch_id)
            events = numbered_arrivals(clean_events(raw).select("key", "ts", *order), batch_id, order)
            self._process(events.select("key", "ts", "arrival"), batch_id)

    def start_messages(
        self, messages: DataFrame, checkpoint: str, order: Sequence[str] = BROKER_ORDER, available_now: bool = True
    ) -> StreamingQuery:
        """From messages to published messages."""
        process = lambda batch, batch_id: self.process_messages(batch, batch_id, order)
        writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def start(self, events: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.process)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def forecasts(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{PUBLISHED}, batch_id bigint").parquet(f"{self.folder}/forecasts")

    def messages(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{MESSAGES}, batch_id bigint").parquet(f"{self.folder}/messages")
