"""The registered queries: every operator over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions import scalars as S
from tillstone.operators import baseline as verification
from tillstone.operators import constraints, file_contract, invariants, reconciliation, replay, reporting, responses
from tillstone.operators import rollup
from tillstone.operators.lookups import in_scope, orphan_counts
from tillstone.operators.posting import mark_posted
from tillstone.operators.ranking import positional_index
from tillstone.operators.validation import accepted, hold_failed_batches, reject_counts
from tillstone.plans import file_path
from tillstone.plans.bank import Bank, batch_file, scenario_of
from tillstone.session import scratch_path
from tillstone.sources.documents import read_approvals, read_baselines
from tillstone.sources.tables import as_json, latest_status, scoped
from tillstone.streaming.intake_stream import intake_orders

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries.
TIGHT_LIMIT = 45
REPORT_METADATA = {"commit": "unversioned", "environment": "supplied orders"}
REPORT_PART = 5
DOCUMENT_ROWS = 10
RUN_SINCE = "1998-01-01 00:00:00"


def query(build: Callable[[Bank], DataFrame]) -> Callable[[Bank], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Bank(spark, folder))
    return build


def query_of_many(build: Callable[[Bank], DataFrame]) -> Callable[[Bank], DataFrame]:
    """A query over views that are made of the same tables."""
    QUERIES[build.__name__] = lambda spark, folder: build(Bank(spark, folder, shared=True))
    return build


# -- scans, intake and scalar functions ---------------------------------------------------------


@query
def staged_scan(bank: Bank) -> DataFrame:
    return bank.staged()


@query
def posted_of_batch(bank: Bank) -> DataFrame:
    return scoped(bank.staged_table(), "posted", 199905).drop("error_message")


@query
def normalize_text(bank: Bank) -> DataFrame:
    return bank.source("documents").select("doc_id", S.squeeze(F.col("text")).alias("text"))


@query
def normalize_conversations(bank: Bank) -> DataFrame:
    return bank.source("conversations").select("conv_id", "turn", S.squeeze(F.col("text")).alias("text"))


@query
def job_durations(bank: Bank) -> DataFrame:
    seconds = S.elapsed_micros(F.col("started_at"), F.col("finished_at")) / 1e6
    return bank.jobs().select(
        "id", seconds.alias("duration_secs"), S.seconds_label(seconds).alias("duration"),
        S.stamp(F.col("started_at")).alias("started"), S.stamp(F.col("started_at"), "file").alias("stamp"),
        S.run_id_of(F.col("started_at")).alias("run_id"),
    )


for file_query in (file_path.file_intake, file_path.control_rows, file_path.run_isolation, file_path.stored_year):
    query(file_query)


@query
def incremental_intake(bank: Bank) -> DataFrame:
    """Orders taken in as a file stream, validated, posted and reconciled batch by batch."""
    return intake_orders(bank.spark, bank.folder)


# -- validation and posting ---------------------------------------------------------------------


@query
def validate_rules(bank: Bank) -> DataFrame:
    return bank.outcomes().select("id", "batch_id", "status", "error_message")


@query
def legacy_rules(bank: Bank) -> DataFrame:
    return bank.legacy_outcomes().select("id", "direction", "amount_cents", "status", "error_message")


@query
def reject_split(bank: Bank) -> DataFrame:
    return bank.errors().select("batch_job_id", "error_message", "record_ref")


@query
def accepted_rows(bank: Bank) -> DataFrame:
    return accepted(bank.outcomes())


@query
def reject_limit(bank: Bank) -> DataFrame:
    return reject_counts(bank.outcomes(), TIGHT_LIMIT)


@query
def held_batches(bank: Bank) -> DataFrame:
    return hold_failed_batches(bank.outcomes(), TIGHT_LIMIT).select("id", "batch_id", "status", "error_message")


@query
def post_ledger(bank: Bank) -> DataFrame:
    return bank.ledger()


@query
def status_merge(bank: Bank) -> DataFrame:
    """Staged, validated and posted snapshots merged to the latest state of every row."""
    outcomes = bank.outcomes()
    columns = ["id", "batch_id", "status"]
    posted = scoped(mark_posted(outcomes), "posted")
    return latest_status([f.select(*columns) for f in (bank.staged(), outcomes, posted)])


# -- reconciliation -----------------------------------------------------------------------------


@query
def reconcile_batches(bank: Bank) -> DataFrame:
    return bank.reconciliations()


@query
def reconcile_both_sides(bank: Bank) -> DataFrame:
    """Also batches the ledger knows and the staged side does not."""
    posted = bank.staged_table().where(F.col("txn_date") < F.lit(RUN_SINCE).cast("date"))
    return reconciliation.reconcile(posted, bank.faulty_ledger(), unseen=True)


@query
def reconcile_run(bank: Bank) -> DataFrame:
    scope = reconciliation.run_batches(bank.batches(), bank.jobs(), F.lit(RUN_SINCE).cast("timestamp"))
    return reconciliation.reconcile(bank.staged_table(), bank.faulty_ledger(), scope)


@query
def recon_gate(bank: Bank) -> DataFrame:
    return reconciliation.gate(bank.reconciliations())


@query_of_many
def run_row_counts(bank: Bank) -> DataFrame:
    """Judged and posted rows of the later run, found through its batches and their load jobs."""
    since = F.lit(RUN_SINCE).cast("timestamp")

    def count(name: str, *statuses: str) -> DataFrame:
        return reconciliation.rows_in_run(bank.staged_table(), bank.batches(), bank.jobs(), since, statuses).select(
            F.lit(name).alias("counter"), "row_count"
        )

    return count("validated", "posted", "rejected").unionByName(count("posted", "posted"))


@query_of_many
def recon_gate_run(bank: Bank) -> DataFrame:
    """The gate of the later run alone, over altered reconciliation rows."""
    since = F.lit(RUN_SINCE).cast("timestamp")
    return reconciliation.gate_run(bank.tampered_reconciliations(), bank.batches(), bank.jobs(), since)


@query
def recon_failures(bank: Bank) -> DataFrame:
    return reconciliation.mismatched(bank.reconciliations())


@query
def exists_semi(bank: Bank) -> DataFrame:
    posted = reconciliation.batches_with_status(bank.staged_table(), "posted")
    return in_scope(bank.batches().withColumnRenamed("id", "batch_id"), posted, "batch_id").select(
        "batch_id", "file_name"
    )


@query
def distinct_batches(bank: Bank) -> DataFrame:
    return reconciliation.batches_with_status(bank.outcomes(), "validated")


@query_of_many
def collector_metrics(bank: Bank) -> DataFrame:
    return bank.outputs().metrics


@query
def collector_transactions(bank: Bank) -> DataFrame:
    return bank.outputs().transactions


@query
def collector_errors(bank: Bank) -> DataFrame:
    return bank.outputs().errors


# -- reports and listings -----------------------------------------------------------------------


@query
def summary_jobs(bank: Bank) -> DataFrame:
    return reporting.job_totals(bank.jobs())


@query
def summary_files(bank: Bank) -> DataFrame:
    return reporting.file_summary(bank.batches(), bank.staged_table())


@query
def summary_totals(bank: Bank) -> DataFrame:
    return reporting.state_totals(bank.staged_table())


@query
def summary_reject_reasons(bank: Bank) -> DataFrame:
    return reporting.reject_reasons(bank.errors())


@query
def summary_recon(bank: Bank) -> DataFrame:
    return reporting.reconciliation_summary(bank.reconciliations(), bank.batches())


@query_of_many
def table_counts(bank: Bank) -> DataFrame:
    return reporting.table_counts(bank.tables())


@query
def scalar_counts(bank: Bank) -> DataFrame:
    tables = bank.tables()
    return reporting.counts_in_one_row({n: tables[n] for n in ("customers", "accounts", "merchants")})


@query
def txn_enriched_top20(bank: Bank) -> DataFrame:
    return reporting.enriched_transactions(bank.ledger(), bank.accounts(), bank.customers(), bank.merchants())


@query
def txn_enriched(bank: Bank) -> DataFrame:
    return reporting.enriched_transactions(bank.ledger(), bank.accounts(), bank.customers(), bank.merchants(), None)


@query
def list_jobs(bank: Bank) -> DataFrame:
    return reporting.listing(
        bank.jobs(), ["id", "job_name", "status", "record_count", "started_at", "finished_at"], "id"
    )


@query
def list_batches(bank: Bank) -> DataFrame:
    return reporting.listing(bank.batches(), ["id", "batch_job_id", "file_name", "record_count", "status"], "id")


@query
def list_staged_top20(bank: Bank) -> DataFrame:
    columns = ["id", "batch_id", "account_id", "merchant_id", "direction", "amount_cents", "status"]
    return reporting.listing(bank.staged_table(), columns, "id", 20)


@query
def list_errors_top20(bank: Bank) -> DataFrame:
    return reporting.listing(bank.errors(), ["batch_job_id", "error_message", "record_ref"], "record_ref", 20)


@query
def list_recon(bank: Bank) -> DataFrame:
    return reporting.listing(bank.reconciliations(), bank.reconciliations().columns, "batch_id")


# -- invariants and constraints -----------------------------------------------------------------


@query_of_many
def inv_checks(bank: Bank) -> DataFrame:
    return invariants.check_invariants(bank.tampered_reconciliations(), bank.staged_table())


@query_of_many
def inv_scoped(bank: Bank) -> DataFrame:
    """Only the batches of the later run are looked at."""
    scope = reconciliation.run_batches(bank.batches(), bank.jobs(), F.lit(RUN_SINCE).cast("timestamp"))
    return invariants.check_invariants(bank.tampered_reconciliations(), bank.staged_table(), scope)


@query
def dup_recon(bank: Bank) -> DataFrame:
    return invariants.duplicate_batches(bank.tampered_reconciliations())


@query_of_many
def pk_audit(bank: Bank) -> DataFrame:
    return constraints.audit(bank.tables(), kinds=["primary_key"])


@query_of_many
def not_null_audit(bank: Bank) -> DataFrame:
    return constraints.audit(bank.tables(), kinds=["not_null"])


@query_of_many
def check_audit(bank: Bank) -> DataFrame:
    return constraints.audit(bank.tables(), kinds=["check"])


@query_of_many
def fk_audit(bank: Bank) -> DataFrame:
    return constraints.audit(bank.tables(), kinds=["foreign_key"])


@query
def fk_orphans(bank: Bank) -> DataFrame:
    return orphan_counts(bank.staged(), "account_id", bank.accounts(), "account_id")


# -- baseline comparison ------------------------------------------------------------------------


@query
def normalize_ledger(bank: Bank) -> DataFrame:
    return verification.normalize_transactions(bank.legacy_outputs().transactions)


@query
def ledger_positions(bank: Bank) -> DataFrame:
    indexed = verification.index_transactions(bank.legacy_outputs().transactions)
    return indexed.select("dataset_id", "idx", "account_id", "amount_cents", "direction", "description")


@query
def document_positions(bank: Bank) -> DataFrame:
    """Place of each document among those of its language, by size."""
    rows = bank.source("documents").select("lang", "n_chars", "doc_id")
    return positional_index(rows, ["lang"], ["n_chars"], ["doc_id"])


@query_of_many
def field_compare(bank: Bank) -> DataFrame:
    return verification.compare_fields(*bank.compared())


@query_of_many
def approval_classify(bank: Bank) -> DataFrame:
    return verification.verify(*bank.compared(), bank.approvals())[0]


@query_of_many
def classify_from_documents(bank: Bank) -> DataFrame:
    """The same findings with the baselines written as JSON documents in parts and approvals as JSON lines, both read back."""
    run, legacy = bank.compared()
    folder = scratch_path(bank.spark, "documents")
    verification.baseline_documents(legacy, DOCUMENT_ROWS).write.json(f"{folder}/baselines")
    bank.approvals().write.json(f"{folder}/approvals")
    golden = verification.baseline_outputs(read_baselines(bank.spark, f"{folder}/baselines", lines=True))
    return verification.verify(run, golden, read_approvals(bank.spark, f"{folder}/approvals"))[0]


@query_of_many
def verification_rollup(bank: Bank) -> DataFrame:
    return verification.verify(*bank.compared(), bank.approvals())[1]


@query_of_many
def verification_report(bank: Bank) -> DataFrame:
    """The report with its findings as JSON texts, one per dataset and part."""
    classified, results = verification.verify(*bank.compared(), bank.approvals())
    named = bank.approvals().select("dataset_id").distinct().withColumn("description", F.concat(F.lit("orders of "), "dataset_id"))
    return as_json(verification.report(results, classified, named, REPORT_METADATA, REPORT_PART))


# -- contracts and replays ----------------------------------------------------------------------


@query
def file_contract_rows(bank: Bank) -> DataFrame:
    return file_contract.check_lines(bank.file_lines())


@query
def file_contract_status(bank: Bank) -> DataFrame:
    lines = bank.file_lines()
    return file_contract.file_status(lines.select("file").distinct(), file_contract.check_lines(lines))


def _document_files(bank: Bank) -> DataFrame:
    return bank.source("documents").select(F.col("doc_id").cast("string").alias("file"), F.col("text").alias("content"))


@query
def file_contract_documents(bank: Bank) -> DataFrame:
    """Whole documents as files; prose has no contracted header."""
    return file_contract.check_contents(_document_files(bank))


@query
def response_conformance(bank: Bank) -> DataFrame:
    return responses.check_responses(bank.responses(), responses.standard_scenarios(bank.spark))


@query
def response_rollup(bank: Bank) -> DataFrame:
    log = bank.responses()
    return responses.response_status(log, responses.check_responses(log, responses.standard_scenarios(bank.spark)))


def _replay_inputs(bank: Bank) -> tuple[DataFrame, DataFrame, DataFrame]:
    def by_year(frame: DataFrame) -> DataFrame:
        return frame.withColumn("scenario_id", scenario_of(F.col("batch_id")))

    totals = replay.scenario_totals(
        by_year(bank.staged_table()), by_year(bank.faulty_ledger()), by_year(bank.errors())
    )
    expected = bank.expectations()
    return expected, totals, replay.run_details(bank.replay_runs(), bank.reconciliations(), expected)


@query_of_many
def replay_details(bank: Bank) -> DataFrame:
    return _replay_inputs(bank)[2]


@query_of_many
def replay_compare(bank: Bank) -> DataFrame:
    compared = replay.compare_replays(*_replay_inputs(bank))
    return compared.withColumn("mismatches", F.array_join("mismatches", " | "))


def _recorded_checks(bank: Bank) -> DataFrame:
    """Every file, response scenario and the invariants as recorded checks."""
    lines = bank.file_lines()
    month = F.pmod("batch_id", F.lit(100))
    files = bank.staged().select("batch_id").distinct().select(
        F.lit("ACH-FILE-001").alias("contract_id"),
        batch_file(F.col("batch_id")).alias("check_id"),
        F.when(month == 6, "WARNING").otherwise("FAIL").alias("expected_status"),
        F.when(month.isin(2, 10), "ACH-FILE-001-COL-MISSING").when(month == 4, "ACH-FILE-001-COL-EXTRA")
        .when(month == 6, "ACH-FILE-001-COL-ORDER").when(month == 8, "ACH-FILE-001-DELIM").alias("expected_rule"),
    )
    file_hits = file_contract.check_lines(lines).select(
        F.lit("ACH-FILE-001").alias("contract_id"), F.col("subject").alias("check_id"), "severity", "rule_id"
    )
    log = bank.responses()
    scenarios = log.select("contract_id", F.col("scenario").alias("check_id")).distinct().select(
        "*", F.lit("PASS").alias("expected_status"), F.lit(None).cast("string").alias("expected_rule")
    )
    response_hits = responses.check_responses(log, responses.standard_scenarios(bank.spark)).select(
        "contract_id", F.col("scenario").alias("check_id"), "severity", "rule_id"
    )
    output_hits = invariants.check_invariants(bank.tampered_reconciliations(), bank.staged_table()).select(
        F.col("subject").alias("contract_id"), F.lit("OUTPUT-TAMPER-DETECTED").alias("check_id"), "severity", "rule_id"
    )
    output = bank.batches().agg(F.count("*").alias("n")).select(
        F.lit(invariants.SUBJECT).alias("contract_id"), F.lit("OUTPUT-TAMPER-DETECTED").alias("check_id"),
        F.lit("FAIL").alias("expected_status"), F.lit("INV-003-TOTAL").alias("expected_rule"),
    )
    checks = files.unionByName(scenarios).unionByName(output)
    hits = file_contract.union_findings([file_hits, response_hits, output_hits])
    return rollup.record_checks(rollup.check_outcomes(checks, hits))


@query_of_many
def contract_checks(bank: Bank) -> DataFrame:
    return _recorded_checks(bank)


@query_of_many
def contract_rollup(bank: Bank) -> DataFrame:
    return rollup.contract_status(_recorded_checks(bank))


@query_of_many
def suite_rollup(bank: Bank) -> DataFrame:
    replays = replay.compare_replays(*_replay_inputs(bank))
    return rollup.suite_status(rollup.contract_status(_recorded_checks(bank)), replays)
