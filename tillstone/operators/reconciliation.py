"""Staged against ledger, batch by batch; the gate; the per-dataset output metrics."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.scalars import all_true, zero_if_null
from tillstone.model import LOAD_JOB, POSTED_STATE, REJECTED_STATE
from tillstone.operators.lookups import having_rows


class ReconciliationMismatch(RuntimeError):
    """Some batches do not balance; their reconciliation rows and the summary exist all the same."""

    summary = None


def _side(frame: DataFrame, prefix: str) -> DataFrame:
    return frame.groupBy("batch_id").agg(
        F.count("*").alias(f"{prefix}_count"),
        F.coalesce(F.sum("amount_cents"), F.lit(0)).cast("bigint").alias(f"{prefix}_total_cents"),
    )


def run_batches(batches: DataFrame, jobs: DataFrame, since: Column) -> DataFrame:
    """Batches whose load job started in this run."""
    loads = jobs.where((F.col("job_name") == LOAD_JOB) & (F.col("started_at") >= since))
    return batches.join(loads.select(F.col("id").alias("batch_job_id")), "batch_job_id").select(
        F.col("id").alias("batch_id")
    )


def rows_in_run(staged: DataFrame, batches: DataFrame, jobs: DataFrame, since: Column, statuses: Sequence[str]) -> DataFrame:
    """One row: how many staged rows with one of the statuses lie in batches whose load job started in this run.

    Rows are counted per batch before they meet the run's batches, so the join carries one row per batch.
    """
    counted = staged.where(F.col("status").isin(*statuses)).groupBy("batch_id").agg(F.count("*").alias("rows"))
    scope = run_batches(batches, jobs, since).distinct()
    return counted.join(scope, "batch_id", "left_semi").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"))


def gate_run(reconciliations: DataFrame, batches: DataFrame, jobs: DataFrame, since: Column) -> DataFrame:
    """The gate over the reconciliations of the batches whose load job started in this run."""
    scope = run_batches(batches, jobs, since).distinct()
    return gate(reconciliations.join(scope, "batch_id", "left_semi"))


def batches_with_status(staged: DataFrame, status: str) -> DataFrame:
    """The distinct batches that hold rows of a status."""
    return having_rows(staged, F.col("status") == status, "batch_id")


def reconcile(staged: DataFrame, ledger: DataFrame, scope: DataFrame | None = None, unseen: bool = False) -> DataFrame:
    """Count and sum both sides of every batch with a posted row.

    Each side is reduced to one row per batch before they meet, so a huge batch costs no more than
    its partial sums. `unseen` also reports ledger batches without any posted staged row.
    """
    left = _side(staged.where(F.col("status") == POSTED_STATE), "staged")
    right = _side(ledger, "posted")
    if scope is not None:
        left = left.join(scope.select("batch_id").distinct(), "batch_id", "left_semi")
        if unseen:
            right = right.join(scope.select("batch_id").distinct(), "batch_id", "left_semi")
    figures = left.join(right, "batch_id", "full" if unseen else "left")
    columns = ["staged_count", "posted_count", "staged_total_cents", "posted_total_cents"]
    filled = figures.select("batch_id", *[zero_if_null(F.col(c)).alias(c) for c in columns])
    return filled.select(
        "*",
        (F.col("staged_count") == F.col("posted_count")).alias("counts_match"),
        (F.col("staged_total_cents") == F.col("posted_total_cents")).alias("totals_match"),
    )


def mismatched(reconciliations: DataFrame) -> DataFrame:
    return reconciliations.where(~F.col("counts_match") | ~F.col("totals_match"))


def gate(reconciliations: DataFrame) -> DataFrame:
    """One row: how many batches fail, and whether the run may pass."""
    return mismatched(reconciliations).agg(F.count("*").alias("failed_batches")).withColumn(
        "may_pass", F.col("failed_batches") == 0
    )


class Outputs(NamedTuple):
    """What a run left behind, keyed by dataset_id.

    metrics:      one row per dataset with counts, total and reconciliation flags
    transactions: dataset_id, account_id, merchant_id, direction, amount_cents, description, ref
    errors:       dataset_id, error_message, record_ref
    """

    metrics: DataFrame
    transactions: DataFrame
    errors: DataFrame


def collect_outputs(
    staged: DataFrame, ledger: DataFrame, errors: DataFrame, reconciliations: DataFrame | None = None
) -> Outputs:
    """Assemble the comparable output of each dataset; inputs carry a dataset_id column."""
    key = "dataset_id"
    states = staged.groupBy(key).agg(
        F.count("*").alias("staged_count"),
        F.count_if(F.col("status") == POSTED_STATE).alias("posted_count"),
        F.count_if(F.col("status") == REJECTED_STATE).alias("rejected_count"),
    )
    faults = errors.groupBy(key).agg(F.count("*").alias("error_count"))
    totals = ledger.groupBy(key).agg(
        F.count("*").alias("ledger_count"), F.sum("amount_cents").cast("bigint").alias("total_posted_cents")
    )
    metrics = states.join(faults, key, "full").join(totals, key, "full")
    flags = ["counts_match", "totals_match"]
    if reconciliations is not None:
        matched = reconciliations.groupBy(key).agg(*[all_true(F.col(f)).alias(f) for f in flags])
        metrics = metrics.join(matched, key, "left")
    else:
        metrics = metrics.select("*", *[F.lit(True).alias(f) for f in flags])
    counts = [
        "staged_count", "posted_count", "rejected_count", "error_count", "ledger_count", "total_posted_cents"
    ]
    metrics = metrics.select(
        key,
        *[zero_if_null(F.col(c)).alias(c) for c in counts],
        *[F.coalesce(F.col(f), F.lit(True)).alias(f) for f in flags],
    )
    transactions = ledger.select(
        key, "account_id", "merchant_id", "direction", F.col("amount_cents").cast("bigint").alias("amount_cents"),
        "description", F.col("txn_id").cast("string").alias("ref"),
    )
    return Outputs(metrics, transactions, errors.select(key, "error_message", "record_ref"))
