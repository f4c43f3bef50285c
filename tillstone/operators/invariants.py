"""Post-run invariants over the reconciliation table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.scalars import zero_if_null
from tillstone.model import INVARIANTS, POSTED_STATE
from tillstone.operators.lookups import in_scope
from tillstone.session import cut_lineage

SUBJECT = "OUTPUT-RECON-001"

# Rule, invariant, count column, text after the invariant, expected, actual.
CHECKS = [
    ("INV-001", "INV-001", "counts_off", "counts_match = false in {n} reconciliation row(s)",
     "counts_match = true", "counts_match = false in {n} row(s)"),
    ("INV-002", "INV-002", "totals_off", "totals_match = false in {n} reconciliation row(s)",
     "totals_match = true", "totals_match = false in {n} row(s)"),
    ("INV-003-COUNT", "INV-003", "count_stale", "staged_count mismatch in {n} row(s)",
     "staged_count = COUNT(staged_transactions WHERE status='posted')", "staged_count mismatch in {n} row(s)"),
    ("INV-003-TOTAL", "INV-003", "total_stale", "staged_total_cents mismatch in {n} row(s)",
     "staged_total_cents = SUM(staged_transactions.amount_cents WHERE status='posted')",
     "staged_total_cents mismatch in {n} row(s)"),
    ("INV-004", "INV-004", "repeated", "{n} batch_id(s) have more than one reconciliation row",
     "1 row per batch_id", "duplicate rows for {n} batch_id(s)"),
    ("INV-005", "INV-005", "negative", "{n} reconciliation row(s) have negative counts",
     "staged_count >= 0 AND posted_count >= 0", "negative count in {n} row(s)"),
    ("INV-006", "INV-006", "excess", "{n} reconciliation row(s) have posted_count > staged_count",
     "posted_count <= staged_count", "posted_count exceeds staged_count in {n} row(s)"),
]
_FIGURES = [check[2] for check in CHECKS]


def duplicate_batches(reconciliations: DataFrame) -> DataFrame:
    """Batches with more than one reconciliation row."""
    return reconciliations.groupBy("batch_id").agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def _figures(reconciliations: DataFrame, staged: DataFrame) -> DataFrame:
    """One row holding the number of offenders of every check."""
    fresh = staged.where(F.col("status") == POSTED_STATE).groupBy("batch_id").agg(
        F.count("*").alias("now_count"), F.sum("amount_cents").alias("now_total")
    )
    staged_count, posted_count = F.col("staged_count"), F.col("posted_count")
    per_batch = reconciliations.join(fresh, "batch_id", "left").groupBy("batch_id").agg(
        F.count_if(~F.col("counts_match")).alias("counts_off"),
        F.count_if(~F.col("totals_match")).alias("totals_off"),
        F.count_if(staged_count != zero_if_null(F.col("now_count"))).alias("count_stale"),
        F.count_if(F.col("staged_total_cents") != zero_if_null(F.col("now_total"))).alias("total_stale"),
        (F.count("*") > 1).cast("int").alias("repeated"),
        F.count_if((staged_count < 0) | (posted_count < 0)).alias("negative"),
        F.count_if(posted_count > staged_count).alias("excess"),
    )
    return per_batch.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _FIGURES])


def _fill(text: str, count: Column) -> Column:
    before, after = text.split("{n}")
    return F.concat(F.lit(before), count.cast("string"), F.lit(after))


def check_invariants(reconciliations: DataFrame, staged: DataFrame, scope: DataFrame | None = None) -> DataFrame:
    """One finding per broken invariant, with the number of offending rows.

    `scope` lists the batch_ids looked at; rows of other batches play no part. A listed null id is
    refused, an empty list is itself a finding.
    """
    spark = reconciliations.sparkSession
    if scope is not None:
        scope = cut_lineage(scope.select("batch_id").distinct())
        if not scope.where(F.col("batch_id").isNull()).isEmpty():
            raise ValueError("batch ids must not be null")
        if scope.isEmpty():
            return spark.createDataFrame(
                [(SUBJECT, "OUTPUT-RECON-SETUP", "FAIL", "No batch_ids were supplied for invariant checking",
                  "at least one batch_id in scope", "batch_ids = []", 0)],
                "subject STRING, rule_id STRING, severity STRING, description STRING, expected STRING, "
                "actual STRING, offenders BIGINT",
            )
        reconciliations = in_scope(reconciliations, scope, "batch_id")
        staged = in_scope(staged, scope, "batch_id")
    lines = F.array(*[
        F.struct(
            F.lit(SUBJECT).alias("subject"),
            F.lit(rule).alias("rule_id"),
            F.lit("FAIL").alias("severity"),
            _fill(f"{INVARIANTS[invariant]} — {text}", F.col(figure)).alias("description"),
            F.lit(expected).alias("expected"),
            _fill(actual, F.col(figure)).alias("actual"),
            F.col(figure).alias("offenders"),
        )
        for rule, invariant, figure, text, expected, actual in CHECKS
    ])
    listed = _figures(reconciliations, staged).select(F.explode(lines).alias("f")).select("f.*")
    return listed.where(F.col("offenders") > 0)
