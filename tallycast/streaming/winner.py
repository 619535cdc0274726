"""The projected winner as a live view: a row per change, kept without reading every key's forecast again.

A micro-batch's new forecasts replace their keys' old ones. Unless the winner's own forecast falls, the new winner is the old one or the best of the
batch, so a batch costs what it brings; only when the winner falls are the other keys' latest forecasts read. All state is named by one manifest.
"""

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.operators.lookup import join_dimension
from tallycast.session import materialize, scratch_scope
from tallycast.streaming import manifest

LATEST = "key string, rank bigint, forecast double, batch_id bigint"
CHANGES = "batch_id bigint, key string, votes bigint, previous string"
FOLDERS = 16  # of latest forecasts, before they are merged into one


class LiveWinner:
    """Over ``(key, at, forecast)`` rows in micro-batches; of a key's forecasts the one of the greatest ``at`` counts, later batches are newer.

    ``keys`` are ``(key, rank)``, one row each; forecasts of other keys, and those that are null or NaN, don't take part. Ties go to the lower rank.
    """

    def __init__(self, folder: str, keys: DataFrame):
        self.folder, self.keys = folder, keys.select("key", F.col("rank").cast("bigint").alias("rank"))

    @staticmethod
    def _best(rows: DataFrame) -> dict[str, Any] | None:
        best = rows.agg(F.min(F.struct((-F.col("forecast")).alias("down"), "rank", "key")).alias("best")).first().best
        return None if best is None else {"key": best.key, "rank": best.rank, "forecast": -best.down}

    def _latest(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        rows = spark.read.schema(LATEST).parquet(*paths)
        newest = F.max_by(F.struct("rank", "forecast", "batch_id"), "batch_id").alias("_newest")
        return rows.groupBy("key").agg(newest).select("key", "_newest.*")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch; a replay gives the same state."""
        with scratch_scope(batch.sparkSession):
            spark = batch.sparkSession
            before = manifest.newest(spark, self.folder, before=batch_id) or {}
            here = manifest.attempt_folder(self.folder, batch_id)
            sound = batch.filter(F.col("forecast").isNotNull() & ~F.isnan("forecast"))
            newest = sound.groupBy("key").agg(F.max_by("forecast", "at").alias("forecast"))
            known = join_dimension(newest, self.keys, "key", "inner")
            fresh = materialize(known.select("key", "rank", "forecast", F.lit(batch_id).cast("bigint").alias("batch_id")), "fresh")
            fresh.write.parquet(f"{here}/latest")
            paths = [*before.get("latest", []), f"{here}/latest"]

            old, best = before.get("winner"), self._best(fresh)
            winner = best if old is None else old
            if old is not None and best is not None:
                own = fresh.filter(F.col("key") == old["key"]).first()
                if own is not None and own.forecast < old["forecast"]:
                    winner = self._best(self._latest(spark, paths))  # the old forecast is taken back: any key may lead now
                elif own is not None:
                    winner = best
                else:
                    winner = min(old, best, key=lambda x: (-x["forecast"], x["rank"], x["key"]))
            if len(paths) > FOLDERS:
                self._latest(spark, paths).write.parquet(f"{here}/merged")
                paths = [f"{here}/merged"]
            state: dict[str, Any] = {"batch_id": batch_id, "latest": paths, "winner": winner}
            if winner is not None and (old is None or winner["key"] != old["key"]):
                state["change"] = [batch_id, winner["key"], int(winner["forecast"]), None if old is None else old["key"]]
            manifest.commit(spark, self.folder, batch_id, state)
            manifest.drop_other_attempts(spark, self.folder, batch_id, here)

    def changes(self, spark: SparkSession) -> DataFrame:
        """``(batch_id, key, votes, previous)``, a row for each micro-batch that changed the winner; votes are cut to whole numbers."""
        found = (manifest.manifest(spark, self.folder, batch_id) for batch_id in manifest.committed(spark, self.folder))
        return spark.createDataFrame([tuple(x["change"]) for x in found if "change" in x], CHANGES)
