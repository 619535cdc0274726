"""Session settings and the shared scratch folder."""

from __future__ import annotations

import io
import pathlib
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes the post-shuffle partitions, switches small sides to
# broadcast by their measured size, and splits skewed join partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cpus: str | int = 8, app: str = "tallycast", **extra: str) -> SparkSession:
    """Local session for tests and the benchmark; on a cluster pass your own session instead."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {**SETTINGS, "spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "8g", **extra}
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per session, so that they need no installed copy and no shared working folder.

    The registered queries do so; a job that uses the operators calls it once.
    """
    context = spark.sparkContext
    if getattr(context, "_tallycast_shipped", False):
        return
    package = pathlib.Path(__file__).resolve().parent
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    # Executors fetch it from the shared folder.
    java = spark.sparkContext._jvm
    place = java.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tallycast-{uuid.uuid4().hex}.zip")
    out = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(raw.getvalue()))
    out.close()
    context.addPyFile(place.toString())
    context._tallycast_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``, or set on the context.

    Only a local session may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local($|\[)", context.master):  # not local-cluster
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallycast-"))
    return context.getCheckpointDir()


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes on exit what ``materialize`` wrote within; use it where the results have been written elsewhere by then."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can write."""
    java = spark.sparkContext._jvm
    place = java.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_folder(spark)}/tallycast-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    Cuts the lineage: later stages re-read files when executors are lost, and their
    size on storage tells the optimizer whether the table is small enough to broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    made = _made.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
