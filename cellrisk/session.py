"""Session settings, and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


PARTITIONS_PER_GB = 8

# Temporary folder of each local application, and the scratch paths of each application.
_LOCAL_DIRS: dict[str, str] = {}
_SCRATCH: dict[str, list[str]] = {}


def build_session(
    app: str = "cellrisk", master: str | None = None, input_gb: float | None = None, **conf: str
) -> SparkSession:
    """Session with the settings the operators assume; `conf` keys use `_` for `.`.

    `input_gb`, the size of the largest table to shuffle, sets the number of shuffle partitions before
    adaptive coalescing to one per 128 MB. Adaptive execution merges small partitions but does not make
    new ones, so 100 TB need about 800,000 / (compression and column pruning) of them, not 200.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    if input_gb:
        partitions = max(200, int(input_gb * PARTITIONS_PER_GB))
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(partitions)
    settings.update({k.replace("_", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir` as the cluster names it.

    Only in local mode, where driver and executors are one process, an unset folder is replaced
    by a temporary one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    app = spark.sparkContext.applicationId
    if app in _LOCAL_DIRS:
        return _LOCAL_DIRS[app]
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="cellrisk-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    _LOCAL_DIRS[app] = local
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables this application wrote to the shared folder. Frames that read them end too."""
    files = spark._jvm.org.apache.hadoop.fs
    for name in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        path = files.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    Cuts the lineage, survives executor loss, and gives later joins the true size, so Spark picks a
    broadcast only for a table that has proved small.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
