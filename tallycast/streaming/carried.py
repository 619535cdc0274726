"""Live refits from carried state: what a refit reads doesn't grow with the stream's life.

Minutes lie in blocks of 2**BLOCK_BITS. For blocks that are over, the state keeps one summary of lag products per key (``closed``), and one per
key and block (``sums``); summaries join exactly. A refit reads ``closed``, the minutes of the blocks since, and nothing before. A late event
that falls into a closed block marks that block of its key: the next refit works out the marked blocks' minutes again and joins that key's block
summaries anew, so the work goes with the late events and not with the minutes between them and the refit.

All tables of a micro-batch become visible by one manifest (see ``manifest``).
"""

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallycast.functions import stretches
from tallycast.functions.times import minute_start
from tallycast.operators import autoregression as ar
from tallycast.operators import lagsums
from tallycast.operators.lagsums import SUMMARY, SUMMARY_NAMES
from tallycast.operators.refit import history_parts, refit_summaries
from tallycast.operators.triggers import candidate_changes, numbered, place, trigger_points
from tallycast.session import materialize, scratch_scope
from tallycast.streaming import manifest
from tallycast.streaming.refit import MARK, PUBLISHED, TOTALS

BLOCK_BITS = 10  # 1024 minutes
PARTS = "key string, epoch_minute bigint, n bigint, first_arrival bigint, last_arrival bigint, latest_ts timestamp_ntz, total bigint"
SUMS = f"key string, block bigint, batch_id bigint, {SUMMARY}"
FAN_BITS = 5  # 32 blocks are joined to a wider one


def _gathered(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """The summaries of each series in the order of their blocks, as ``parts``: one row per closed prefix, open or marked block."""
    return rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("block", *SUMMARY_NAMES))).alias("parts"))


def _wholes(column: pa.Array, lags: int) -> list[stretches.Stretch]:
    return [stretches.fold([lagsums.stretch_of(part, lags) for part in parts]) for parts in column.to_pylist()]


def joined_versions(rows: DataFrame, first: int, last: int, lags: int) -> DataFrame:
    """Whole series, ``(key, interval, SUMMARY)``, from the versions of their blocks ``first`` to ``last``: one wherever a block has one.

    Neighbouring blocks are joined to wider ones until one is left, so a block's version costs the joins on its way up and not
    one with every other block.
    """
    names = ["block", "interval", *SUMMARY_NAMES]
    rows = rows.select("key", (F.col("block") - first).alias("block"), *names[1:])

    def fold(x: dict[str, pa.Array]) -> stretches.Versions:
        block, interval = x.pop("block").to_numpy(), x.pop("interval").to_numpy()
        found = lagsums.stretches_of(x, lags)
        begin = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
        return stretches.fold_versions([(interval[i:j], found.take(slice(i, j))) for i, j in zip(begin, [*begin[1:], len(block)])])

    width = last - first
    while width:
        wider = rows.withColumn("wide", F.shiftright("block", FAN_BITS)).groupBy("key", "wide")
        gathered = wider.agg(F.sort_array(F.collect_list(F.struct(*names))).alias("parts"))
        rows = lagsums.map_versions(gathered, fold, ["key", "wide"]).withColumnRenamed("wide", "block")
        width >>= FAN_BITS
    return rows.drop("block")


def version_models(rows: DataFrame, n: int, lags: int, exact: bool = False) -> DataFrame:
    """A model per version of a series, for the refits ``interval`` to ``until`` (of ``n``) that saw it:
    ``(key, interval, until, n, last_ts, last_value, tail, phi, status)``."""
    until = F.coalesce(F.lead("interval").over(W.partitionBy("key").orderBy("interval")) - 1, F.lit(n - 1).cast("bigint"))
    by = ["key", "interval", "until"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wholes = [lagsums.stretch_of(row, lags) for row in batch.select(SUMMARY_NAMES).to_pylist()]
            if exact:
                found = lagsums.exact_models(wholes, lags)
                phi, status, n = found["phi"], found["status"], found["n"]
            else:
                phi, status, n = lagsums.fit_conditional(wholes, lags)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in by),
                    pa.array(n, pa.int64()),
                    pa.array([x.last_minute for x in wholes], pa.int64()),
                    pa.array([x.last_total for x in wholes], pa.float64()),
                    pa.array([[*x.tail[::-1], *[None] * (lags - len(x.tail))] for x in wholes], pa.list_(pa.float64())),
                    pa.array([None if np.isnan(x).any() else x.tolist() for x in phi], pa.list_(pa.float64())),
                    pa.array(list(status), pa.string()),
                ],
                names=[*by, "n", "last_minute", "last_value", "tail", "phi", "status"],
            )

    models = rows.withColumn("until", until).repartition("key", "interval").mapInArrow(
        run,
        "key string, interval bigint, until bigint, n bigint, last_minute bigint, last_value double, tail array<double>, phi array<double>, "
        "status string",
    )
    return models.withColumn("last_ts", minute_start(F.col("last_minute"))).drop("last_minute")


def joined_summaries(rows: DataFrame, lags: int) -> DataFrame:
    """One summary per key: ``(key, SUMMARY)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wholes = _wholes(batch.column("parts"), lags)
            values = {name: [getattr(x, name) for x in wholes] for name in SUMMARY_NAMES}
            kinds = {"n": pa.int64(), "first_minute": pa.int64(), "last_minute": pa.int64(), "first_total": pa.float64(), "last_total": pa.float64()}
            arrays = [pa.array(values[name], kinds.get(name, pa.list_(pa.float64()))) for name in SUMMARY_NAMES]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *arrays], names=["key", *SUMMARY_NAMES])

    return _gathered(rows, ["key"]).mapInArrow(run, f"key string, {SUMMARY}")


class CarriedRefit:
    """Refits over ``(key, ts, arrival)`` events in micro-batches; later batches carry larger arrival numbers.

    The state below ``folder`` is named by each batch's manifest: ``mark`` (the newest refit candidate), ``totals`` (count per key), ``parts``
    (per block the folders with its minutes), ``closed`` and ``sums`` (see above; blocks below ``boundary`` are closed), ``late`` (folders
    with parts that came for closed blocks since the last refit) and the batch's ``forecasts``. ``exact`` fits by maximum likelihood.
    """

    def __init__(
        self, folder: str, lags: int = ar.LAGS, horizon: int = ar.LIVE_HORIZON, digits: int | None = None, exact: bool = False,
        bits: int = BLOCK_BITS,
    ):
        self.folder, self.lags, self.horizon, self.digits, self.exact, self.bits = folder, lags, horizon, digits, exact, bits

    def _write(self, df: DataFrame, path: str, *partitions: str) -> str:
        if partitions:  # ranges, so that a folder gets files of few tasks and a large one is still shared out
            df.repartitionByRange(*partitions, "key", "epoch_minute").write.partitionBy(*partitions).parquet(path)
        else:
            df.write.parquet(path)
        return path

    def _read(self, spark: SparkSession, schema: str, paths: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch; its scratch tables are removed at the end, also after a failure."""
        with scratch_scope(batch.sparkSession):
            self._process(batch, batch_id)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = manifest.newest(spark, self.folder, before=batch_id) or {}
        here = manifest.attempt_folder(self.folder, batch_id)
        state: dict[str, Any] = {"batch_id": batch_id, "folder": here}
        events = materialize(batch.select("key", "ts", "arrival"), "batch")

        changes = materialize(candidate_changes(events), "changes")
        candidates = self._read(spark, MARK, before.get("mark", [])).unionByName(changes)
        triggers = materialize(trigger_points(candidates).join(changes.select("arrival"), "arrival", "left_semi"), "triggers")
        newest = candidates.agg(F.max_by(F.struct("arrival", "ts"), "arrival").alias("_newest"))
        state["mark"] = [self._write(newest.select("_newest.*").filter("arrival IS NOT NULL"), f"{here}/mark")]

        parts = history_parts(events, triggers).drop("interval")
        totals = self._read(spark, TOTALS, before.get("totals", []))
        so_far = totals.select(F.col("key").alias("_key"), "so_far")
        shifted = parts.join(so_far, F.col("key").eqNullSafe(F.col("_key")), "left").select(
            "key", F.shiftright("epoch_minute", self.bits).alias("block"), "epoch_minute", "n", "first_arrival", "last_arrival", "latest_ts",
            (F.col("total") + F.coalesce("so_far", F.lit(0))).alias("total"),
        )
        shifted = materialize(shifted, "parts")
        added = shifted.groupBy("key").agg(F.sum("n").alias("so_far"))
        merged = totals.unionByName(added).groupBy("key").agg(F.sum("so_far").alias("so_far"))
        state["totals"] = [self._write(merged, f"{here}/totals")]

        # Block numbers are bounded by the calendar.
        blocks = sorted(row.block for row in shifted.select("block").distinct().collect())
        boundary = before.get("boundary")
        state["parts"] = {block: list(paths) for block, paths in before.get("parts", {}).items()}
        if blocks:
            self._write(shifted, f"{here}/parts", "block")
        for block in blocks:
            state["parts"].setdefault(str(block), []).append(f"{here}/parts/block={block}")
        late = [f"{here}/parts/block={block}" for block in blocks if boundary is not None and block < boundary]
        state["late"] = before.get("late", []) + late
        state |= {name: before.get(name) for name in ("boundary", "closed", "sums")}
        state["forecasts"] = []
        if not triggers.isEmpty():
            self._refit(spark, triggers, state, here)
        manifest.commit(spark, self.folder, batch_id, state)
        manifest.drop_other_attempts(spark, self.folder, batch_id, here)

    def _parts(self, spark: SparkSession, state: dict[str, Any], blocks: list[int]) -> DataFrame:
        """The minutes of some blocks; nothing else is read."""
        return self._minutes(spark, [path for block in blocks for path in state["parts"][str(block)]])

    def _minutes(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        return self._read(spark, PARTS, paths).withColumn("block", F.shiftright("epoch_minute", self.bits))

    def _refit(self, spark: SparkSession, triggers: DataFrame, state: dict[str, Any], here: str) -> None:
        n = triggers.count()
        known = sorted(map(int, state["parts"]))
        boundary = state["boundary"] if state["boundary"] is not None else known[0]
        marked = sorted({int(path.rsplit("=", 1)[1]) for path in state["late"]})
        pair = ["key", "block"]
        touched = self._parts(spark, state, [block for block in known if block >= boundary])
        late_pairs = None
        if marked:
            late_pairs = materialize(self._minutes(spark, state["late"]).select(*pair).distinct(), "late")
            again = self._parts(spark, state, marked)
            touched = touched.unionByName(_semi(again, late_pairs, pair))
        pieces = place(touched.withColumn("arrival", F.col("last_arrival")), triggers).drop("arrival")
        pieces = materialize(pieces.withColumn("key", F.struct("key", "block")).drop("block"), "pieces")
        seen = refit_summaries(pieces, self.lags).select(F.col("key.key").alias("key"), F.col("key.block").alias("block"), "interval", *SUMMARY_NAMES)
        seen = materialize(seen, "seen")

        # The closed blocks' summary takes the place of the last of them.
        closed = self._read(spark, f"key string, {SUMMARY}", state["closed"] or []).withColumn("block", F.lit(boundary - 1).cast("bigint"))
        base = closed
        if late_pairs is not None:
            # Keys with late events: their block summaries one by one, without the marked ones, which were worked out again.
            late_keys = late_pairs.select("key").distinct()
            sums = self._sums(spark, state["sums"] or [])
            own = _anti(_semi(sums, late_keys, ["key"]), late_pairs, pair)
            base = _anti(closed, late_keys, ["key"]).unionByName(own)
        base = materialize(base.select(*pair, *SUMMARY_NAMES), "base")
        # Interval n, behind the last trigger, is the state at the batch's end, which no refit saw.
        rows = base.withColumn("interval", F.lit(0).cast("bigint")).unionByName(seen.filter(F.col("interval") < n))
        wholes = joined_versions(rows, (known[0] if marked else boundary) - 1, known[-1], self.lags)
        models = materialize(version_models(wholes, n, self.lags, self.exact), "models")
        refits = numbered(triggers).select("interval", F.col("arrival").alias("refit_arrival"), F.col("ts").alias("refit_ts"))

        def at_refits(found: DataFrame) -> DataFrame:
            return found.withColumn("interval", F.explode(F.sequence("interval", "until"))).drop("until").join(refits, "interval").drop("interval")

        ahead = at_refits(ar.forecast(models, self.horizon, ["interval", "until", "key"]))
        if self.digits is not None:
            ahead = ahead.withColumn("forecast", F.round("forecast", self.digits) + F.lit(0.0))
        state["forecasts"] = [self._write(ahead, f"{here}/forecasts")]
        state["models"] = [self._write(at_refits(models), f"{here}/models")]

        # Close what lies before the newest block.
        until = known[-1]
        newest = F.max_by(F.struct(*SUMMARY_NAMES), "interval").alias("_newest")
        over = seen.filter(F.col("block") < until).groupBy(*pair).agg(newest).select(*pair, "_newest.*")
        state["closed"] = [self._write(joined_summaries(base.unionByName(over), self.lags), f"{here}/closed")]
        state["sums"] = (state["sums"] or []) + [
            self._write(over.withColumn("batch_id", F.lit(state["batch_id"]).cast("bigint")).select(*pair, "batch_id", *SUMMARY_NAMES), f"{here}/sums")
        ]
        shut = [block for block in known if boundary <= block < until] + marked
        shut = [block for block in shut if len(state["parts"][str(block)]) > 1]
        if shut:  # one folder per closed block, so that the manifest grows with blocks and not with batches
            self._write(self._parts(spark, state, shut), f"{here}/kept", "block")
            state["parts"] |= {str(block): [f"{here}/kept/block={block}"] for block in shut}
        state["boundary"], state["late"] = max(until, boundary), []

    def _sums(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        """The newest summary of each key and closed block."""
        newest = F.max_by(F.struct(*SUMMARY_NAMES), "batch_id").alias("_newest")
        return self._read(spark, SUMS, paths).groupBy("key", "block").agg(newest).select("key", "block", "_newest.*")

    def start(self, events: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.process)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def _published(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        found = [manifest.manifest(spark, self.folder, batch_id).get(name, []) for batch_id in manifest.committed(spark, self.folder)]
        return self._read(spark, schema, [path for paths in found for path in paths])

    def forecasts(self, spark: SparkSession) -> DataFrame:
        """All forecasts of committed batches."""
        return self._published(spark, "forecasts", PUBLISHED)

    def models(self, spark: SparkSession) -> DataFrame:
        """All models of committed batches."""
        return self._published(
            spark, "models",
            "refit_arrival bigint, refit_ts timestamp_ntz, key string, n bigint, last_ts timestamp_ntz, last_value double, tail array<double>, "
            "phi array<double>, status string",
        )

    def totals(self, spark: SparkSession) -> DataFrame:
        """The counts as of the last committed batch."""
        return self._read(spark, TOTALS, (manifest.newest(spark, self.folder) or {}).get("totals", []))


def _same(rows: DataFrame, other: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    renamed = other.select(*[F.col(name).alias(f"_{name}") for name in names])
    return rows.join(renamed, reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in names]), how)


def _semi(rows: DataFrame, other: DataFrame, names: Sequence[str]) -> DataFrame:
    return _same(rows, other, names, "left_semi")


def _anti(rows: DataFrame, other: DataFrame, names: Sequence[str]) -> DataFrame:
    return _same(rows, other, names, "left_anti")
