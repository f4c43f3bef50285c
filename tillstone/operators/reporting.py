"""Summary report sections and table listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.functions.scalars import elapsed_micros, pass_label, zero_if_null
from tillstone.model import POSTED_STATE, REJECTED_STATE, STAGED_STATE, VALIDATED_STATE
from tillstone.operators.lookups import lookup_join

# Status buckets of the report and the states they count.
BUCKETS = {
    "posted": POSTED_STATE,
    "validated": VALIDATED_STATE,
    "rejected": REJECTED_STATE,
    "still_staged": STAGED_STATE,
}


def _buckets() -> list:
    return [F.count_if(F.col("status") == state).alias(name) for name, state in BUCKETS.items()]


def job_totals(jobs: DataFrame) -> DataFrame:
    """Completed work per job name over all runs, in order of first appearance."""
    spent = elapsed_micros(F.col("started_at"), F.col("finished_at"))
    return (
        jobs.where(F.col("status") == "completed")
        .groupBy("job_name")
        .agg(
            F.sum("record_count").cast("bigint").alias("record_count"),
            (F.sum(spent) / 1e6).alias("duration_secs"),
            F.min("id").alias("first_id"),
        )
        .select("job_name", F.lit("completed").alias("status"), "record_count", "duration_secs", "first_id")
        .orderBy("first_id")
    )


def file_summary(batches: DataFrame, staged: DataFrame) -> DataFrame:
    """Every inbound file with its rows by state, files without rows included."""
    states = staged.groupBy(F.col("batch_id").alias("id")).agg(*_buckets())
    return (
        batches.select("id", "file_name", "record_count")
        .join(states, "id", "left")
        .select("id", "file_name", "record_count", *[zero_if_null(F.col(b)).alias(b) for b in BUCKETS])
        .orderBy("id")
    )


def state_totals(staged: DataFrame) -> DataFrame:
    return staged.agg(F.count("*").alias("total"), *_buckets())


def reject_reasons(errors: DataFrame) -> DataFrame:
    return errors.groupBy("error_message").agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "error_message")


def reconciliation_summary(reconciliations: DataFrame, batches: DataFrame) -> DataFrame:
    named = reconciliations.join(batches.select(F.col("id").alias("batch_id"), "file_name"), "batch_id")
    return named.select(
        "batch_id", "file_name", "staged_count", "posted_count", "counts_match", "totals_match",
        pass_label(F.col("counts_match"), F.col("totals_match")).alias("result"),
    ).orderBy("batch_id")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one line each."""
    counted = [
        frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
    ]
    return reduce(lambda a, b: a.unionAll(b), counted)


def counts_in_one_row(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table as the columns of a single row."""
    names = list(tables)
    return table_counts(tables).agg(
        *[F.sum(F.when(F.col("table_name") == n, F.col("row_count"))).cast("bigint").alias(n) for n in names]
    )


def enriched_transactions(
    ledger: DataFrame, accounts: DataFrame, customers: DataFrame, merchants: DataFrame, limit: int | None = 20
) -> DataFrame:
    """Ledger rows with holder and merchant names, by id; the listing shows the first `limit`."""
    holders = lookup_join(accounts.select("account_id", "customer_id"),
                          customers.select("customer_id", "full_name"), "customer_id", "inner")
    rows = ledger.select("txn_id", "account_id", "merchant_id", "direction", "amount_cents", "status")
    named = lookup_join(rows, holders.select("account_id", "full_name"), "account_id", "inner")
    shops = merchants.select("merchant_id", F.col("name").alias("merchant_name"))
    columns = ["txn_id", "account_id", "full_name", "merchant_name", "direction", "amount_cents", "status"]
    if limit is None:
        return lookup_join(named, shops, "merchant_id").select(*columns).orderBy("txn_id")
    # A left join loses no row, so the first rows can be chosen before it.
    first = named.orderBy("txn_id").limit(limit)
    return lookup_join(first, shops, "merchant_id").select(*columns).orderBy("txn_id").limit(limit)


def listing(table: DataFrame, columns: list[str], key: str, limit: int | None = None) -> DataFrame:
    """A control or audit table by key; `limit` is the length of the listing."""
    ordered = table.select(*columns).orderBy(key)
    return ordered if limit is None else ordered.limit(limit)
