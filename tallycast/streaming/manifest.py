"""One commit for all tables of a micro-batch.

A batch writes its tables into a folder of its own attempt and then a manifest that names them. Readers start from a manifest, so they see all of a
batch's tables or none, also while a batch is written, has failed half-way, or is replayed.
"""

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    java = spark.sparkContext._jvm
    place = java.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place, java


def attempt_folder(folder: str, batch_id: int) -> str:
    """A fresh folder for one attempt at a batch."""
    return f"{folder}/data/{batch_id:012d}/{uuid.uuid4().hex}"


def drop_other_attempts(spark: SparkSession, folder: str, batch_id: int, keep: str) -> None:
    """Remove what failed or replayed attempts at a batch left behind, but for ``keep``."""
    system, place, _ = _file_system(spark, f"{folder}/data/{batch_id:012d}")
    for status in system.listStatus(place):
        if status.getPath().getName() != keep.rsplit("/", 1)[1]:
            system.delete(status.getPath(), True)


def _manifest_path(folder: str, batch_id: int) -> str:
    return f"{folder}/manifest/{batch_id:012d}.json"


def commit(spark: SparkSession, folder: str, batch_id: int, content: dict[str, Any]) -> None:
    """Make a batch visible: written aside, then renamed, so a manifest is whole or not there. A replay's manifest takes the first one's place."""
    system, place, java = _file_system(spark, _manifest_path(folder, batch_id))
    aside = java.org.apache.hadoop.fs.Path(f"{folder}/manifest/.{batch_id:012d}-{uuid.uuid4().hex}")
    out = system.create(aside, True)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    if system.exists(place):
        system.delete(place, False)
    if not system.rename(aside, place):
        raise OSError(f"can't commit batch {batch_id} in {folder}")


def committed(spark: SparkSession, folder: str) -> list[int]:
    """The batches that have a manifest, in order."""
    system, place, _ = _file_system(spark, f"{folder}/manifest")
    if not system.exists(place):
        return []
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and not name.startswith("."))


def manifest(spark: SparkSession, folder: str, batch_id: int) -> dict[str, Any]:
    system, place, java = _file_system(spark, _manifest_path(folder, batch_id))
    stream = system.open(place)
    try:
        return json.loads(java.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def newest(spark: SparkSession, folder: str, before: int | None = None) -> dict[str, Any] | None:
    """The manifest of the last committed batch (before ``before``, for a batch that may be a replay)."""
    if before is not None and before > 0:  # the usual case, without a listing that grows with the stream
        system, place, _ = _file_system(spark, _manifest_path(folder, before - 1))
        if system.exists(place):
            return manifest(spark, folder, before - 1)
    found = [x for x in committed(spark, folder) if before is None or x < before]
    return manifest(spark, folder, found[-1]) if found else None
