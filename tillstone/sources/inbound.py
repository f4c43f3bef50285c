"""Inbound delimited files: positional CSV scan, and raw lines with their physical line numbers."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstone.functions.scalars import is_blank
from tillstone.model import INBOUND
from tillstone.operators.lookups import lookup_join
from tillstone.session import cut_lineage

# Lines that begin with this mark are comments.
COMMENT_MARK = "#"
CORRUPT = "_corrupt"
INBOUND_WITH_CORRUPT = f"{INBOUND}, {CORRUPT} STRING"


class LineBlocks(NamedTuple):
    """Lines keyed by the split they were read from, and one row per split.

    lines:  file, block, slot, value
    blocks: file, block, first_slot, n, lines_before, header, has_text
    """

    lines: DataFrame
    blocks: DataFrame


def read_inbound_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Scan listed files with one reader; columns bind by position, header names are ignored."""
    return (
        spark.read.schema(INBOUND_WITH_CORRUPT)
        .option("header", True)
        .option("enforceSchema", True)
        .option("comment", COMMENT_MARK)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(paths if isinstance(paths, str) else list(paths))
        .select("*", F.col("_metadata.file_path").alias("file"))
    )


def empty_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """Files of length zero under the given paths, which Spark's own scans leave out.

    Names that begin with `_` or `.` are markers of other jobs, no inbound files, as in Spark's scans.
    """
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        for entry in store.globStatus(pattern) or []:
            members = store.listStatus(entry.getPath()) if entry.isDirectory() else [entry]
            found += [m.getPath().toUri().toString() for m in members
                      if m.isFile() and m.getLen() == 0 and m.getPath().getName()[0] not in "_."]
    return found


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file, empty files included; the contents are not read."""
    filled = (
        spark.read.format("binaryFile")
        .load(paths if isinstance(paths, str) else list(paths))
        .select(F.col("_metadata.file_path").alias("file"), "length")
    )
    empty = [(name, 0) for name in empty_files(spark, paths)]
    return filled.unionByName(spark.createDataFrame(empty, "file STRING, length BIGINT")) if empty else filled


def pin_splits(spark: SparkSession) -> None:
    """Make the split plan of a file set independent of how many executors are alive.

    Line numbers are put together from two scans of the same files, which must be cut alike.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def scan_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Raw lines with file and split; CR before LF is left on the value."""
    pin_splits(spark)
    return (
        spark.read.option("lineSep", "\n")
        .text(paths if isinstance(paths, str) else list(paths))
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            "value",
        )
    )


def index_blocks(raw: DataFrame) -> LineBlocks:
    """Give each line its place in the read order and describe each split, in one pass.

    `raw` must come straight from a scan: within a split the places are then consecutive.
    """
    lines = raw.withColumn("slot", F.monotonically_increasing_id())
    opening = F.when(F.col("block") == 0, F.struct("slot", "value"))
    per_block = lines.groupBy("file", "block").agg(
        F.min("slot").alias("first_slot"),
        F.count("*").alias("n"),
        F.max(~is_blank(F.col("value"))).alias("has_text"),
        F.min(opening)["value"].alias("opening"),
    )
    # A window row stands for one split, so even a file of many terabytes gives few of them.
    whole = Window.partitionBy("file")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = per_block.select(
        "file",
        "block",
        "first_slot",
        "n",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("lines_before"),
        F.max("opening").over(whole).alias("header"),
        F.max("has_text").over(whole).alias("has_text"),
    )
    return LineBlocks(lines, cut_lineage(blocks))


def read_line_blocks(spark: SparkSession, paths: str | Sequence[str]) -> LineBlocks:
    return index_blocks(scan_lines(spark, paths))


def number_lines(source: LineBlocks, *carry: str) -> DataFrame:
    """file, row_no (1 = first physical line), value and the carried block columns.

    There is one block row per split, so it is broadcast and the lines stay where they were read; a
    set of files with too many splits for that is joined on the split, whose size the reader bounds.
    A line outside the block it should be in means that the files were cut differently this time,
    and fails the job.
    """
    joined = lookup_join(source.lines, source.blocks, ["file", "block"], "left", measure=True)
    place = F.col("slot") - F.col("first_slot")
    found = place.isNotNull() & (place >= 0) & (place < F.col("n"))
    moved = F.raise_error(F.concat(F.lit("splits changed between two scans of "), "file"))
    return joined.select(
        "file",
        F.when(found, F.col("lines_before") + place + 1).otherwise(moved.cast("bigint")).alias("row_no"),
        "value",
        *carry,
    )
