"""The inbound-file path over the supplied orders: years written as delimited files, taken in and run."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.model import RECONCILE_JOB
from tillstone.operators.intake import INBOUND_ORDER
from tillstone.plans.bank import Bank, file_cells
from tillstone.plans.daily_run import Store, load, run_batches, validate_run
from tillstone.session import scratch_path

READ_YEAR = 1995
RUNS = (1_741_568_400_000, 1_741_654_800_000)


def write_years(bank: Bank) -> str:
    """Write every staged row to a delimited file in the folder of its year; returns the pattern of the folders.

    Large years become several files, and files of different years may have equal names.
    """
    folder = scratch_path(bank.spark, "inbound")
    cells = [cell.alias(name) for cell, name in zip(file_cells(), INBOUND_ORDER)]
    rows = bank.staged().select(F.floor(F.col("batch_id") / 100).alias("year"), *cells).hint("rebalance", "year")
    rows.write.option("header", True).option("emptyValue", "").partitionBy("year").csv(folder)
    return f"{folder}/year=*"


def year_of(path: Column) -> Column:
    return F.regexp_extract(path, "year=([0-9]+)", 1).cast("bigint")


def _store(bank: Bank) -> Store:
    return Store(bank.spark, scratch_path(bank.spark, "store"))


def file_intake(bank: Bank) -> DataFrame:
    """What loading made of the lines of each year; the second load finds nothing left to do."""
    store, paths = _store(bank), write_years(bank)
    for _ in range(2):
        load(store, paths, RUNS[0])
    taken = store.table("intake", RUNS[0]).groupBy(year_of(F.col("file")).alias("year"), "problem")
    return taken.agg(
        F.count("*").alias("row_count"), F.sum("amount_cents").cast("bigint").alias("total_cents"),
        F.min("txn_date").alias("first_date"), F.max("txn_date").alias("last_date"),
        F.count("line").alias("kept_lines"),
    )


def control_rows(bank: Bank) -> DataFrame:
    """The control rows of a run; how many files a year is cut into is not part of them."""
    store = _store(bank)
    run_batches(bank.spark, store.root, write_years(bank), RUNS[0], bank.accounts(), limit=sys.maxsize)
    count = F.when(F.col("job_name") != RECONCILE_JOB, F.col("record_count"))
    return store.table("stage_runs").select(
        "run_id", "job_name", "status", count.alias("record_count"), F.col("finished_at").isNotNull().alias("finished")
    )


def run_isolation(bank: Bank) -> DataFrame:
    """The same files taken in by two runs: each run keeps batches, ledger rows, rejects and figures of its own."""
    store, paths = _store(bank), write_years(bank)
    for run_id in RUNS:
        run_batches(bank.spark, store.root, paths, run_id, bank.accounts(), limit=sys.maxsize)
    keys = ["run_id", "batch_id"]
    years = store.table("intake").select(*keys, year_of(F.col("file")).alias("year")).distinct()
    sections = [
        store.table("batches").select(*keys, F.col("record_count").alias("loaded_count")),
        store.table("batch_job_errors").groupBy(*keys).agg(F.count("*").alias("error_count")),
        store.table("transactions").groupBy(*keys).agg(F.count("*").alias("ledger_count")),
        store.table("batch_reconciliations"),
    ]
    figures = years
    for section in sections:
        figures = figures.join(section, keys, "left")
    counts = ["loaded_count", "error_count", "ledger_count", "staged_count", "posted_count", "staged_total_cents", "posted_total_cents"]
    return figures.groupBy("run_id", "year").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.bool_and("counts_match").alias("counts_match"), F.bool_and("totals_match").alias("totals_match"),
    )


def stored_year(bank: Bank) -> DataFrame:
    """The judged rows of one year's files, read from the buckets of their batches in the stored table."""
    store, paths = _store(bank), write_years(bank)
    load(store, paths, RUNS[0])
    validate_run(store, RUNS[0], bank.accounts(), limit=sys.maxsize)
    batches = store.table("intake", RUNS[0]).where(year_of(F.col("file")) == READ_YEAR)
    return store.of_batches("outcomes", batches).groupBy("status").agg(
        F.count("*").alias("row_count"), F.sum("amount_cents").cast("bigint").alias("total_cents")
    )
