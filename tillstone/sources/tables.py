"""Parquet tables: scoped scans and idempotent writes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """Read a table of the store with its declared schema; one never written is empty."""
    try:
        return spark.read.schema(schema).parquet(f"{root}/{name}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scoped(frame: DataFrame, status: str | None = None, batch_id=None) -> DataFrame:
    """Rows of one status and/or one batch; both reach the scan as filters where they are stored columns."""
    if status is not None:
        frame = frame.where(F.col("status") == status)
    if batch_id is not None:
        frame = frame.where(F.col("batch_id") == F.lit(batch_id))
    return frame


def _gathered(frame: DataFrame, by: Sequence[str], gather: bool) -> DataFrame:
    """Bring the rows of a partition value together when a shuffle has scattered them.

    The adaptive engine splits a value that is far too large over several tasks. Rows that come
    straight from a scan lie together already and are left where they are.
    """
    return frame.hint("rebalance", *by) if gather else frame


def _counted(frame: DataFrame, count: Column | None) -> tuple[DataFrame, Observation]:
    """The frame with its rows counted while they are written; `count` restricts what is counted."""
    seen = Observation()
    return frame.observe(seen, F.coalesce(F.count(F.lit(1)) if count is None else F.count_if(count), F.lit(0)).alias("rows")), seen


def write_partitions(
    frame: DataFrame, root: str, name: str, by: Sequence[str], gather: bool = True, count: Column | None = None
) -> int:
    """Replace the partitions present in the frame, leave all others alone, and return the rows written.

    Running the same write again gives the same table. Rows are counted in the writing stage itself, whose tasks
    each count once however often they are tried.
    """
    counted, seen = _counted(_gathered(frame, by, gather), count)
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(f"{root}/{name}")
    )
    return seen.get["rows"]


def write_under(
    frame: DataFrame, root: str, name: str, place: dict[str, int], by: Sequence[str], gather: bool = True, count: Column | None = None
) -> int:
    """Replace everything below one place of a table, also what this frame no longer holds; returns the rows written.

    The place is given by leading partition columns, such as the run; `by` are the further ones.
    """
    counted, seen = _counted(_gathered(frame.drop(*place), by, gather), count)
    folder = "/".join(f"{column}={value}" for column, value in place.items())
    counted.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(f"{root}/{name}/{folder}")
    return seen.get["rows"]


def write_json(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").json(path)


def as_json(frame: DataFrame) -> DataFrame:
    """One JSON text per row, absent fields included."""
    return frame.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def with_status(frame: DataFrame, cases: Sequence[tuple[Column, str]]) -> DataFrame:
    """Set the status by the first case that holds; other rows keep theirs."""
    chosen = reduce(lambda acc, case: acc.when(case[0], case[1]), cases[1:], F.when(*cases[0]))
    return frame.withColumn("status", chosen.otherwise(F.col("status")))


def latest_status(snapshots: Sequence[DataFrame], key: str = "id") -> DataFrame:
    """Merge stage snapshots, oldest first: the latest row of every key wins."""
    ranked = [s.withColumn("_stage", F.lit(n)) for n, s in enumerate(snapshots)]
    merged = reduce(lambda a, b: a.unionByName(b), ranked)
    row = F.struct(*snapshots[0].columns)
    return merged.groupBy(key).agg(F.max_by(row, "_stage").alias("_row")).select("_row.*")
