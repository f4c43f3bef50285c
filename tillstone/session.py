"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tillstone", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Call sites in error messages cost several round trips per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in spark.checkpoint.dir.

    Only a local session, where driver and executors share one disk, may fall back to a folder
    of its own; on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="tillstone-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tillstone-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, kept apart from other applications."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; frames built on it end with that."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Write the frame to the shared folder once and read it back.

    Later reads see exactly these rows even when executors are lost, read only the columns they
    need, and Catalyst knows the true size.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, "cut")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
