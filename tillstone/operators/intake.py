"""Load inbound files into staged rows, once per (run, file)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.scalars import control_trim, intake_date
from tillstone.model import LOAD_JOB, STAGED_STATE
from tillstone.operators.lookups import lookup_join
from tillstone.sources.inbound import COMMENT_MARK, LineBlocks, number_lines, read_line_blocks

# Fixed value: columns in file order; the header text plays no part.
INBOUND_ORDER = ["account_id", "merchant_id", "direction", "amount_cents", "txn_date"]


class Intake(NamedTuple):
    staged: DataFrame
    quarantine: DataFrame


def file_name_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def batch_key(run_id: int | None, path: Column) -> Column:
    """A batch is one file of one run, so the same file in a later run is a batch of its own.

    The key holds the name, for reading, and a hash of the whole path, since files in different
    folders may have equal names. `file:/x` and `file:///x` are one path.
    """
    whole = F.substring(F.md5(F.regexp_replace(path, "^file:/+", "file:/")), 1, 16)
    key = F.concat(file_name_of(path), F.lit("-"), whole)
    return key if run_id is None else F.concat(F.lit(f"{run_id}-"), key)


def unprocessed(files: DataFrame, processed: DataFrame, run_id: int) -> DataFrame:
    """Files of this run that were not taken in yet."""
    seen = processed.where(F.col("run_id") == run_id).select("id").distinct()
    keyed = files.withColumn("id", batch_key(run_id, F.col("file")))
    return keyed.join(seen, "id", "left_anti").drop("id")


def parse_lines(lines: DataFrame, batch_id: Column) -> DataFrame:
    """Cut numbered data lines into typed columns; `problem` tells why a line cannot be staged."""
    is_data = (F.col("row_no") > 1) & (control_trim(F.col("value")) != "") & ~F.col("value").startswith(COMMENT_MARK)
    raw = ", ".join(f"{c} STRING" for c in INBOUND_ORDER) + ", surplus STRING"
    text = F.regexp_replace("value", "\r$", "")
    cut = lines.where(is_data).select(
        batch_id.alias("batch_id"), "file", "row_no", text.alias("line"), F.from_csv(text, raw).alias("c")
    )

    def number(name: str) -> Column:
        return F.trim(F.col(f"c.{name}")).try_cast("int")

    merchant_text = F.coalesce(F.trim("c.merchant_id"), F.lit(""))
    direction = F.coalesce(F.trim("c.direction"), F.lit(""))
    problem = (
        F.when(F.col("c.txn_date").isNull() | F.col("c.surplus").isNotNull(), "wrong number of cells")
        .when(number("account_id").isNull(), "account_id is not an integer")
        .when((merchant_text != "") & number("merchant_id").isNull(), "merchant_id is not an integer")
        .when(number("amount_cents").isNull(), "amount_cents is not an integer")
        .when(F.length(direction) > 1, "direction is longer than one character")
        .when(intake_date(F.col("c.txn_date")).isNull(), "txn_date is not a date")
    )
    return cut.select(
        F.concat_ws(":", "batch_id", "row_no").alias("id"),
        "batch_id",
        number("account_id").alias("account_id"),
        number("merchant_id").alias("merchant_id"),
        direction.alias("direction"),
        number("amount_cents").alias("amount_cents"),
        intake_date(F.col("c.txn_date")).alias("txn_date"),
        F.lit(STAGED_STATE).alias("status"),
        "file",
        "row_no",
        F.when(problem.isNotNull(), F.col("line")).alias("line"),
        problem.alias("problem"),
    )


def judge_merchants(parsed: DataFrame, merchants: DataFrame) -> DataFrame:
    """A line naming an unknown merchant cannot be staged; a line without one can."""
    known = merchants.select("merchant_id", F.lit(True).alias("_known"))
    unknown = F.col("merchant_id").isNotNull() & F.col("_known").isNull()
    return (
        lookup_join(parsed, known, "merchant_id")
        .withColumn("problem", F.coalesce("problem", F.when(unknown, "merchant does not exist")))
        .drop("_known")
    )


def split_intake(parsed: DataFrame) -> Intake:
    """Stage what can be staged and set the rest aside, with the reason.

    Unknown accounts and bad amounts are staged; validation judges them.
    """
    staged = parsed.where(F.col("problem").isNull()).drop("file", "row_no", "line", "problem")
    quarantine = parsed.where(F.col("problem").isNotNull()).select("batch_id", "file", "row_no", "line", "problem")
    return Intake(staged, quarantine)


def parse_blocks(source: LineBlocks, run_id: int | None, merchants: DataFrame | None = None) -> DataFrame:
    parsed = parse_lines(number_lines(source), batch_key(run_id, F.col("file")))
    return parsed if merchants is None else judge_merchants(parsed, merchants)


def parse_files(
    spark: SparkSession, paths: str | Sequence[str], run_id: int, merchants: DataFrame | None = None
) -> DataFrame:
    """One scan over all listed files; every file becomes one batch of the run."""
    return parse_blocks(read_line_blocks(spark, paths), run_id, merchants)


def load_files(
    spark: SparkSession, paths: str | Sequence[str], run_id: int, merchants: DataFrame | None = None
) -> Intake:
    return split_intake(parse_files(spark, paths, run_id, merchants))


def batch_register(files: DataFrame, staged: DataFrame, run_id: int) -> DataFrame:
    """One control row per file with the number of rows staged from it."""
    counts = staged.groupBy(F.col("batch_id").alias("id")).agg(F.count("*").alias("record_count"))
    batches = files.select(
        batch_key(run_id, F.col("file")).alias("id"), file_name_of(F.col("file")).alias("file_name")
    )
    return batches.join(counts, "id", "left").select(
        F.lit(run_id).cast("bigint").alias("run_id"),
        "id",
        "file_name",
        F.coalesce("record_count", F.lit(0)).alias("record_count"),
        F.lit("received").alias("status"),
        F.lit(LOAD_JOB).alias("job_name"),
    )
