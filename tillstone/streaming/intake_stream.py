"""Incremental intake: each file once, each micro-batch written so that a repeat changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.operators.intake import batch_key, parse_blocks, split_intake
from tillstone.operators.lookups import fits_broadcast
from tillstone.operators.posting import mark_posted, post
from tillstone.operators.reconciliation import reconcile
from tillstone.operators.validation import validate
from tillstone.plans.bank import Bank, stage_orders
from tillstone.session import cut_lineage, scratch_path
from tillstone.sources.inbound import index_blocks, pin_splits
from tillstone.sources.tables import write_partitions

FILES_PER_TRIGGER = 1000
# A file is never split over micro-batches, so replacing whole files is safe to repeat.
LANDING_KEY = "file_key"


def land(staged: DataFrame, accounts: DataFrame, root: str) -> None:
    """Validate and post the staged rows of one micro-batch; both tables are keyed by file."""
    outcomes = cut_lineage(validate(staged, accounts))
    shuffled = not fits_broadcast(accounts)
    write_partitions(mark_posted(outcomes), root, "staged_transactions", [LANDING_KEY], shuffled)
    write_partitions(post(outcomes), root, "transactions", [LANDING_KEY], shuffled)


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], root: str) -> None:
    """Process all files not seen yet under this root, then stop."""
    (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{root}/_progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def intake_folder(spark: SparkSession, folder: str, accounts: DataFrame, root: str) -> None:
    """Take in the delimited files that arrived in a folder since the last call."""
    pin_splits(spark)
    stream = (
        spark.readStream.option("lineSep", "\n")
        .option("maxFilesPerTrigger", FILES_PER_TRIGGER)
        .text(folder)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            "value",
        )
    )

    def handle(lines: DataFrame, _epoch: int) -> None:
        parsed = parse_blocks(index_blocks(lines), None).withColumn(LANDING_KEY, batch_key(None, F.col("file")))
        intake = split_intake(parsed)
        land(intake.staged, accounts, root)
        quarantine = intake.quarantine.withColumn(LANDING_KEY, batch_key(None, F.col("file")))
        write_partitions(quarantine, root, "quarantine", [LANDING_KEY], gather=False)

    run_available(stream, handle, root)


def intake_orders(spark: SparkSession, folder: str, files: int = 6, files_per_trigger: int = 2) -> DataFrame:
    """The supplied orders as a file stream, reconciled per month afterwards.

    The orders arrive as several files over several triggers, and every second micro-batch is handed over twice, as after a
    crash between the writes of a batch and the note that it is done.
    """
    bank, root, inbox = Bank(spark, folder), scratch_path(spark, "intake"), scratch_path(spark, "arrivals")
    orders = bank.source("orders")
    orders.repartition(files).write.parquet(inbox)
    stream = (
        spark.readStream.schema(orders.schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(inbox)
        .select("*", batch_key(None, F.col("_metadata.file_path")).alias(LANDING_KEY))
    )

    def handle(rows: DataFrame, epoch: int) -> None:
        staged = stage_orders(rows, LANDING_KEY)
        for _ in range(1 + epoch % 2):
            land(staged, bank.accounts(), root)

    run_available(stream, handle, root)
    return reconcile(
        spark.read.parquet(f"{root}/staged_transactions"), spark.read.parquet(f"{root}/transactions")
    )
