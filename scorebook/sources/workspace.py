"""Folders that driver and executors have to share."""

import os
import uuid
from pathlib import PurePosixPath

from pyspark.sql import SparkSession

#: Local folders that tasks of an application have been found to share with its driver.
_SEEN: set[tuple[str, str]] = set()


def file_system(spark: SparkSession, folder: str):
    """Hadoop's file system and path of a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _seen_by_tasks(spark: SparkSession, folder: str) -> bool:
    """Whether tasks find a file that the driver lays into a folder of the local file system."""
    context, (system, path) = spark.sparkContext, file_system(spark, folder)
    place = PurePosixPath(path.toUri().getPath())
    if any((context.applicationId, str(p)) in _SEEN for p in (place, *place.parents)):
        return True
    mark = f"{place}/.seen-{uuid.uuid4().hex}"
    _, mark_path = file_system(spark, f"file://{mark}")
    system.create(mark_path, False).close()
    try:
        tasks = 4 * context.defaultParallelism
        seen = all(context.parallelize(range(tasks), tasks).map(lambda _: os.path.exists(mark)).collect())
    finally:
        system.delete(mark_path, False)
    if seen:
        _SEEN.add((context.applicationId, str(place)))
    return seen


def require_shared(spark: SparkSession, folder: str) -> str:
    """``folder``, unless it lies on one machine's disk while executors run on others.

    Standalone clusters often share a mounted folder: there a look from the executors decides.
    """
    master = spark.sparkContext.master
    if not master.startswith("local"):
        system, _ = file_system(spark, folder)
        if system.getUri().getScheme() == "file":
            if not master.startswith("spark://") or not _seen_by_tasks(spark, folder):
                raise ValueError(f"{folder} is a local folder, which executors do not share")
    return folder.rstrip("/")


def shared_folder(spark: SparkSession) -> str | None:
    """Where intermediate tables go: ``spark.checkpoint.dir``, else the context's checkpoint folder,
    else the warehouse. A session with no other executors than itself has no need of the last: None."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named or context.master == "local" or context.master.startswith("local["):
        return named
    return spark.conf.get("spark.sql.warehouse.dir", None)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the session's ``shared_folder``."""
    shared = shared_folder(spark)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{require_shared(spark, shared)}/{label}-{uuid.uuid4().hex}"
