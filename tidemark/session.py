"""Session settings and the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every query relies on; the rest is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "tidemark", master: str | None = None, **conf: object) -> SparkSession:
    """A session in UTC with ANSI arithmetic; ``conf`` adds settings, dots written as two underscores."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see, as the session names it in spark.checkpoint.dir.

    Only where it is unset (a local test) a temporary folder is made and set, so that checkpoint()
    works as well; it is removed when the application ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = held.get() if held.isDefined() else None
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        _remove_at_end(spark, folder)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it wants it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _remove_at_end(spark: SparkSession, folder: str) -> None:
    fs, at = file_system(spark, folder)
    fs.mkdirs(at)
    fs.deleteOnExit(at)


_staging: dict[tuple[str, str], str] = {}


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's own part of the shared folder.

    That part is removed when the application ends, so nothing staged outlives it; what is to stay is
    written to a destination the caller names.
    """
    owner = (spark.sparkContext.applicationId, shared_dir(spark))
    if owner not in _staging:
        _staging[owner] = os.path.join(owner[1], f"staged-{uuid.uuid4().hex}")
        _remove_at_end(spark, _staging[owner])
    return os.path.join(_staging[owner], f"{name}-{uuid.uuid4().hex}")


def cut(df):
    """The frame, computed once and kept in the shared folder, so that lost executors cost no recomputation.

    The session's cleaner removes its files when nothing refers to it any more (``SETTINGS``).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Below this many bytes per core an input is small: spreading it costs less than leaving cores idle.
SPREAD_BYTES = 32 * 1024 * 1024


def spread(df, least_bytes: int = SPREAD_BYTES):
    """The frame in as many partitions as there are cores, if it is small and lies in fewer files; else as it is.

    For work that costs far more than a shuffle. Decided from the optimizer's size estimate and the
    number of files, so no job is run for it. A large input is left as its scan splits it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= cores * least_bytes or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)
