"""Replay scenarios: what several runs of one input left behind, against what was expected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.scalars import all_true, within_expectation, zero_if_null
from tillstone.model import REJECTED_STATE
from tillstone.operators.lookups import lookup_join

KEY = "scenario_id"

# Per-run expectation fields and the reconciliation columns they are held against.
RUN_FIELDS = [
    ("stagedCount", "staged_count"),
    ("postedCount", "posted_count"),
    ("stagedTotalCents", "staged_total_cents"),
    ("postedTotalCents", "posted_total_cents"),
    ("countsMatch", "counts_match"),
    ("totalsMatch", "totals_match"),
]

# Label, expectation, observed figure; in message order.
COMPARISONS = [
    ("staged count", "expectedStagedCount", "staged_count"),
    ("posted count", "expectedPostedCount", "posted_count"),
    ("rejected count", "expectedRejectedCount", "rejected_count"),
    ("error count", "expectedErrorCount", "error_count"),
    ("total posted cents", "expectedTotalPostedCents", "total_posted_cents"),
    ("reconciliation row count", "expectedReconciliation.rowCount", "first_run_rows"),
    ("reconciliation counts_match", "expectedReconciliation.countsMatch", "counts_match"),
    ("reconciliation totals_match", "expectedReconciliation.totalsMatch", "totals_match"),
    ("reconciliation staged_count", "expectedReconciliation.stagedCount", "first.staged_count"),
    ("reconciliation posted_count", "expectedReconciliation.postedCount", "first.posted_count"),
    ("reconciliation staged_total_cents", "expectedReconciliation.stagedTotalCents", "first.staged_total_cents"),
    ("reconciliation posted_total_cents", "expectedReconciliation.postedTotalCents", "first.posted_total_cents"),
    ("per-run reconciliation expectations", "per_run_wanted", "per_run_match"),
    ("aggregate staged count", "expectedAfterBothRuns.totalStagedTransactions", "staged_count"),
    ("aggregate posted count", "expectedAfterBothRuns.totalPostedTransactions", "posted_count"),
    ("aggregate reconciliation row count", "expectedAfterBothRuns.reconciliationRowCount", "recon_rows"),
    ("aggregate eachRowCountsMatch", "expectedAfterBothRuns.eachRowCountsMatch", "counts_match"),
    ("aggregate eachRowTotalsMatch", "expectedAfterBothRuns.eachRowTotalsMatch", "totals_match"),
]


def scenario_totals(staged: DataFrame, ledger: DataFrame, errors: DataFrame) -> DataFrame:
    """Counts and total per scenario; posted rows are counted in the ledger. Inputs carry scenario_id."""
    rows = staged.groupBy(KEY).agg(
        F.count("*").alias("staged_count"), F.count_if(F.col("status") == REJECTED_STATE).alias("rejected_count")
    )
    posted = ledger.groupBy(KEY).agg(
        F.count("*").alias("posted_count"), F.sum("amount_cents").cast("bigint").alias("total_posted_cents")
    )
    faults = errors.groupBy(KEY).agg(F.count("*").alias("error_count"))
    return rows.join(posted, KEY, "full").join(faults, KEY, "full").select(
        KEY, *[zero_if_null(F.col(c)).alias(c) for c in
               ("staged_count", "posted_count", "rejected_count", "error_count", "total_posted_cents")]
    )


def run_details(runs: DataFrame, reconciliations: DataFrame, expectations: DataFrame) -> DataFrame:
    """Reconciliation rows of every run with a flag telling whether they meet the expectation.

    `runs` has scenario_id, run_number and batch_id. The per-run part of an expectation decides;
    without one the single-run part does; without both the flag stays null.
    """
    rows = runs.join(reconciliations, "batch_id")
    wanted = expectations.select(F.col("scenarioId").alias(KEY), "expectedPerRun", "expectedReconciliation")
    joined = lookup_join(rows, wanted, KEY, measure=True)

    def meets(part: str) -> Column:
        flag = F.lit(True)
        for field, column in RUN_FIELDS:
            flag = flag & within_expectation(F.col(f"{part}.{field}"), F.col(column))
        return flag

    met = F.when(F.col("expectedPerRun").isNotNull(), meets("expectedPerRun")).when(
        F.col("expectedReconciliation").isNotNull(), meets("expectedReconciliation")
    )
    return joined.select(
        KEY, "run_number", "batch_id", *[c for _, c in RUN_FIELDS], met.alias("expectation_match")
    )


def _mismatch(label: str, expected: str, actual: str) -> Column:
    e, a = F.col(expected), F.col(actual)
    return F.when(
        e.isNotNull() & a.isNotNull() & (e != a),
        F.concat(F.lit(f"{label} expected "), e.cast("string"), F.lit(" but was "), a.cast("string")),
    )


def compare_replays(expectations: DataFrame, totals: DataFrame, details: DataFrame) -> DataFrame:
    """One row per expected scenario: status, ordered mismatch messages and both summaries."""
    first_run = F.col("run_number") == 1
    seen = details.groupBy(KEY).agg(
        F.count("*").alias("recon_rows"),
        all_true(F.col("counts_match")).alias("counts_match"),
        all_true(F.col("totals_match")).alias("totals_match"),
        all_true(F.col("expectation_match")).alias("per_run_match"),
        F.count_if(first_run).alias("first_run_rows"),
        F.min_by(
            F.struct("staged_count", "posted_count", "staged_total_cents", "posted_total_cents"),
            F.when(first_run, F.col("batch_id")),
        ).alias("first"),
    )
    figures = ["staged_count", "posted_count", "rejected_count", "error_count", "total_posted_cents"]
    observed = (
        expectations.withColumn(KEY, F.col("scenarioId"))
        .join(totals, KEY, "left")
        .join(seen, KEY, "left")
        .withColumns({c: zero_if_null(F.col(c)) for c in [*figures, "recon_rows", "first_run_rows"]})
        .withColumns({c: F.coalesce(F.col(c), F.lit(True)) for c in ["counts_match", "totals_match", "per_run_match"]})
        .withColumn("per_run_wanted", F.when(F.col("expectedPerRun").isNotNull(), F.lit(True)))
    )
    return observed.select(
        KEY,
        F.filter(F.array(*[_mismatch(*c) for c in COMPARISONS]), lambda m: m.isNotNull()).alias("mismatches"),
        expected_summary().alias("expected_summary"),
        actual_summary().alias("actual_summary"),
        *figures, "recon_rows", "counts_match", "totals_match",
    ).withColumn("status", F.when(F.size("mismatches") == 0, "PASS").otherwise("FAIL"))


def _pair(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{label}="), F.coalesce(value.cast("string"), F.lit("null")))


def expected_summary() -> Column:
    run, single, after = F.col("expectedPerRun"), F.col("expectedReconciliation"), F.col("expectedAfterBothRuns")
    return F.concat_ws(
        ", ",
        _pair("staged", F.col("expectedStagedCount")),
        _pair("posted", F.col("expectedPostedCount")),
        _pair("rejected", F.col("expectedRejectedCount")),
        _pair("errors", F.col("expectedErrorCount")),
        _pair("total", F.col("expectedTotalPostedCents")),
        F.when(run.isNotNull(), _pair("per-run staged", run["stagedCount"])),
        F.when(run.isNotNull(), _pair("per-run posted", run["postedCount"])),
        F.when(run.isNotNull(), _pair("per-run posted-total", run["postedTotalCents"])),
        F.when(run["stagedTotalCents"].isNotNull(), _pair("per-run staged-total", run["stagedTotalCents"])),
        F.when(single.isNotNull(), _pair("reconRows", single["rowCount"])),
        F.when(after.isNotNull(), _pair("aggregateReconRows", after["reconciliationRowCount"])),
    )


def actual_summary() -> Column:
    per_run = F.when(F.col("per_run_wanted"), F.col("per_run_match").cast("string")).otherwise("n/a")
    return F.concat_ws(
        ", ",
        _pair("staged", F.col("staged_count")),
        _pair("posted", F.col("posted_count")),
        _pair("rejected", F.col("rejected_count")),
        _pair("errors", F.col("error_count")),
        _pair("total", F.col("total_posted_cents")),
        _pair("reconRows", F.col("recon_rows")),
        _pair("countsMatch", F.col("counts_match")),
        _pair("totalsMatch", F.col("totals_match")),
        _pair("perRunMatch", per_run),
    )
