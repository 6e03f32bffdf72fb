"""Session factory and the shared scratch location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tradewind", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the plans are written for.

    On a cluster leave ``master`` unset and size ``spark.sql.shuffle.partitions`` there; adaptive
    execution merges small partitions and splits the skewed ones of sort-merge joins.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_STAGES: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Without the setting a session on one machine takes a temporary folder; any other session has no
    folder that all its executors share, and is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    context = spark.sparkContext
    if not named and not context.getCheckpointDir():
        if not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="tradewind-checkpoint-")
    if named and not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, to be deleted by ``drop_stages``."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{os.urandom(6).hex()}"
    _STAGES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stages(spark: SparkSession) -> list[str]:
    """The scratch paths that this run has handed out and not deleted."""
    return list(_STAGES.get(spark.sparkContext.applicationId, []))


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """The table written to the shared folder and read back.

    Used between costly row work and operators that look at a table more than once: later passes
    read only their columns, and a lost executor costs a re-read, not a re-computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete this run's scratch paths, or those given of them, once nothing reads them any more; how many there were."""
    held = _STAGES.get(spark.sparkContext.applicationId, [])
    paths = [p for p in held if paths is None or p in paths]
    for path in paths:
        held.remove(path)
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)
