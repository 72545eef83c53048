"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs the next operator a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

TASK_ROWS = 500_000

_local_folders: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app_name: str = "meterstar", master: str | None = None, **settings: str) -> SparkSession:
    """Start (or get) a session; keyword settings use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="meterstar-")
    return _local_folders[app]


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/meterstar/{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{_application_folder(spark)}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later steps then read the same rows however often executors are lost, and
    Catalyst knows the exact size, so it broadcasts the table only if it is
    below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = fresh_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def task_parts(spark: SparkSession, rows: int) -> int:
    """Number of partitions that gives a task about ``TASK_ROWS`` of ``rows``.

    Adaptive execution sizes partitions by compressed bytes; rows that compress to a few bytes then fill a task's memory.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def drop_materialised(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; frames that read them are then unusable."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once, for the few Python functions that run there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='meterstar-code-')}/{package.name}", "zip", package.parent, package.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
