import pytest
from pyspark.sql import functions as F

from tillstone.model import ACCOUNTS, CUSTOMERS, EXPECTATION
from tillstone.operators import constraints, invariants, replay, responses, rollup
from tillstone.operators.reconciliation import gate, mismatched, reconcile, run_batches
from tillstone.sources.documents import read_expectations, read_response_contracts, require_expectation_fields

RECON = (
    "batch_id INT, staged_count BIGINT, posted_count BIGINT, staged_total_cents BIGINT, posted_total_cents BIGINT, "
    "counts_match BOOLEAN, totals_match BOOLEAN"
)


def staged(spark, *rows):
    return spark.createDataFrame(list(rows), "batch_id INT, amount_cents INT, status STRING")


def ledger(spark, *rows):
    return spark.createDataFrame(list(rows), "batch_id INT, amount_cents INT")


@pytest.mark.parametrize(
    "ledger_rows, counts, totals",
    [
        ([(1, 5000), (1, 1500)], True, True),
        ([(1, 5000)], False, False),
        ([(1, 5000), (1, 9999)], True, False),
        ([(1, 5000), (1, 1500), (1, 1)], False, False),
        ([(1, 4000), (1, 2500)], True, True),
    ],
)
def test_reconcile_cases(spark, ledger_rows, counts, totals):
    left = staged(spark, (1, 5000, "posted"), (1, 1500, "posted"), (1, 0, "rejected"))
    row = reconcile(left, ledger(spark, *ledger_rows)).first()
    assert (row.staged_count, row.staged_total_cents) == (2, 6500)
    assert (row.counts_match, row.totals_match) == (counts, totals)


def test_reconcile_scope_and_gate(spark):
    left = staged(spark, (1, 5, "posted"), (2, 5, "posted"), (3, 5, "rejected"))
    right = ledger(spark, (1, 5), (9, 5))
    both = reconcile(left, right)
    assert {r.batch_id: r.posted_count for r in both.collect()} == {1: 1, 2: 0}
    assert [r.batch_id for r in mismatched(both).collect()] == [2]
    assert gate(both).first().asDict() == {"failed_batches": 1, "may_pass": False}
    assert {r.batch_id for r in reconcile(left, right, unseen=True).collect()} == {1, 2, 9}
    batches = spark.createDataFrame([(1, 10), (2, 20)], "id INT, batch_job_id INT")
    jobs = spark.createDataFrame(
        [(10, "load_transactions", 1), (20, "load_transactions", 5)], "id INT, job_name STRING, s INT"
    ).withColumn("started_at", F.timestamp_seconds("s"))
    scope = run_batches(batches, jobs, F.timestamp_seconds(F.lit(5)))
    assert [r.batch_id for r in reconcile(left, right, scope).collect()] == [2]


def recon(spark, *rows):
    return spark.createDataFrame(list(rows), RECON)


def test_clean_invariants(spark):
    left = staged(spark, (1, 5000, "posted"), (1, 0, "rejected"), (1, 1500, "posted"))
    clean = recon(spark, (1, 2, 2, 6500, 6500, True, True))
    assert invariants.check_invariants(clean, left).count() == 0


def test_tampered_total_is_the_only_finding(spark):
    left = staged(spark, (1, 31500, "posted"), (2, 31500, "posted"))
    rows = recon(spark, (1, 1, 1, 31501, 31500, True, True), (2, 1, 1, 31500, 31500, True, True))
    found = invariants.check_invariants(rows, left).collect()
    assert [(f.rule_id, f.offenders) for f in found] == [("INV-003-TOTAL", 1)]
    assert found[0].actual == "staged_total_cents mismatch in 1 row(s)"
    later = spark.createDataFrame([(2,)], "batch_id INT")
    assert invariants.check_invariants(rows, left, later).count() == 0


def test_every_invariant_fires(spark):
    left = staged(spark, (1, 10, "posted"))
    rows = recon(spark, (1, 2, 3, 10, 10, False, False), (1, 1, 1, 11, 10, True, True), (7, -1, 0, 0, 0, False, True))
    found = {f.rule_id: f.offenders for f in invariants.check_invariants(rows, left).collect()}
    assert found == {"INV-001": 2, "INV-002": 1, "INV-003-COUNT": 2, "INV-003-TOTAL": 1, "INV-004": 1, "INV-005": 1,
                     "INV-006": 2}


def test_invariant_scope_is_checked(spark):
    rows, left = recon(spark, (1, 1, 1, 5, 5, True, True)), staged(spark, (1, 5, "posted"))
    empty = spark.createDataFrame([], "batch_id INT")
    assert [f.rule_id for f in invariants.check_invariants(rows, left, empty).collect()] == ["OUTPUT-RECON-SETUP"]
    with pytest.raises(ValueError):
        invariants.check_invariants(rows, left, spark.createDataFrame([(1,), (None,)], "batch_id INT"))


def test_constraints(spark):
    customers = spark.createDataFrame(
        [(1001, "A", "a@x", None, None), (1002, "B", "b@x", None, None), (1002, "C", "c@x", None, None)], CUSTOMERS
    )
    accounts = spark.createDataFrame(
        [(2001, 1001, "checking", "active", None, 0), (2002, 1009, "loan", "frozen", None, -5),
         (2003, 1009, "savings", None, None, None)], ACCOUNTS
    )
    audited = constraints.audit({"customers": customers, "accounts": accounts})
    broken = {(r.table_name, r.kind, r.constraint_name): r.offenders for r in constraints.broken(audited).collect()}
    assert broken == {
        ("customers", "primary_key", "customer_id"): 1,
        ("customers", "not_null", "created_at"): 3,
        ("accounts", "not_null", "status"): 1,
        ("accounts", "not_null", "opened_at"): 3,
        ("accounts", "not_null", "credit_limit_cents"): 1,
        ("accounts", "check", "accounts_account_type_check"): 1,
        ("accounts", "check", "accounts_credit_limit_cents_check"): 1,
        ("accounts", "foreign_key", "customer_id->customers.customer_id"): 2,
    }


RUN, POLL = "API-BATCH-RUN-001", "API-BATCH-STATUS-001"


@pytest.mark.parametrize(
    "contract, scenario, status, content_type, body, rules",
    [
        (RUN, "clean_trigger", 200, "Text/Plain; charset=UTF-8", "Pipeline completed successfully", set()),
        (RUN, "clean_trigger", 200, "text/plain", '{"status":"ok"}', {"BODY-EXACT", "PLAINTEXT"}),
        (RUN, "clean_trigger", 500, "application/json", None, {"STATUS", "CONTENT-TYPE", "BODY-EXACT"}),
        (RUN, "concurrent_trigger", 409, "text/plain", "Pipeline is already running", set()),
        (RUN, "concurrent_trigger", 409, "text/plain", "busy", {"BODY-CONTAINS"}),
        (RUN, "pipeline_failure", 500, "text/plain", "Pipeline failed: x", set()),
        (RUN, "pipeline_failure", 500, None, "oops", {"CONTENT-TYPE", "BODY-PREFIX"}),
        (RUN, "nothing", 200, "text/plain", "x", {"SCENARIO-NOT-FOUND"}),
        (POLL, "pipeline_idle", 200, "text/plain", "idle", set()),
        (POLL, "pipeline_running", 200, "text/plain", "[running", {"BODY-EXACT"}),
    ],
)
def test_responses(spark, contract, scenario, status, content_type, body, rules):
    log = spark.createDataFrame(
        [("r1", contract, scenario, status, content_type, body)],
        "response_id STRING, contract_id STRING, scenario STRING, status INT, content_type STRING, body STRING",
    )
    found = responses.check_responses(log, responses.standard_scenarios(spark))
    assert {f.rule_id for f in found.collect()} == {f"{contract}-{r}" for r in rules}
    assert responses.response_status(log, found).first().status == ("FAIL" if rules else "PASS")


def test_response_contract_documents(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '{"contractId": "X", "endpoint": "GET /", "responses": ['
        '{"scenario": "json", "expectedStatus": 200, "contentType": "application/json"},'
        '{"scenario": "any", "expectedStatus": 204},'
        '{"scenario": "any", "expectedStatus": 999}]}'
    )
    scenarios = read_response_contracts(spark, str(tmp_path / "c.json"))
    log = spark.createDataFrame(
        [("1", "X", "json", 200, "application/json", "{}"), ("2", "X", "any", 204, "image/png", "")],
        "response_id STRING, contract_id STRING, scenario STRING, status INT, content_type STRING, body STRING",
    )
    assert responses.check_responses(log, scenarios).count() == 0
    with pytest.raises(Exception):
        read_response_contracts(spark, str(tmp_path / "absent.json"))
    (tmp_path / "bad.json").write_text('{"contractId": ')
    with pytest.raises(Exception):
        read_response_contracts(spark, str(tmp_path / "bad.json")).collect()


def expectation(spark, tmp_path, name, **changes):
    import json

    document = {
        "scenarioId": name, "description": "d", "purpose": "p", "fixtureFile": "f.csv", "runsSubmitted": 1,
        "expectedStagedCount": 3, "expectedPostedCount": 3, "expectedRejectedCount": 0, "expectedErrorCount": 0,
        "expectedTotalPostedCents": 31500, "whatWouldBreakThis": "w",
    } | changes
    path = tmp_path / f"{name}.json"
    path.write_text(json.dumps(document))
    return str(path)


def test_replays(spark, tmp_path):
    one = {"rowCount": 1, "stagedCount": 3, "postedCount": 3, "countsMatch": True, "totalsMatch": True}
    per_run = {"stagedCount": 3, "postedCount": 3, "stagedTotalCents": 31500, "postedTotalCents": 31500,
               "countsMatch": True, "totalsMatch": True}
    after = {"totalStagedTransactions": 6, "totalPostedTransactions": 6, "reconciliationRowCount": 2,
             "eachRowCountsMatch": True, "eachRowTotalsMatch": True}
    paths = [
        expectation(spark, tmp_path, "RP-001", expectedReconciliation=one),
        expectation(spark, tmp_path, "RP-002", expectedPerRun=per_run, expectedAfterBothRuns=after, runsSubmitted=2,
                    expectedStagedCount=6, expectedPostedCount=6, expectedTotalPostedCents=63000),
        expectation(spark, tmp_path, "RP-003", expectedReconciliation=one | {"stagedCount": 2}),
        expectation(spark, tmp_path, "RP-004", expectedPerRun=per_run | {"postedCount": 4}),
    ]
    expected = read_expectations(spark, paths)
    runs, rows, recons, posted = [], [], [], []
    for scenario, n in [("RP-001", 1), ("RP-002", 2), ("RP-003", 1), ("RP-004", 1)]:
        for run in range(1, n + 1):
            batch = f"{scenario}-{run}"
            runs.append((scenario, run, batch))
            recons.append((batch, 3, 3, 31500, 31500, True, True))
            rows += [(scenario, "posted")] * 3
            posted += [(scenario, 10500)] * 3
    rows.append(("RP-003", "rejected"))
    details = replay.run_details(
        spark.createDataFrame(runs, "scenario_id STRING, run_number INT, batch_id STRING"),
        spark.createDataFrame(recons, RECON.replace("batch_id INT", "batch_id STRING")),
        expected,
    )
    totals = replay.scenario_totals(
        spark.createDataFrame(rows, "scenario_id STRING, status STRING"),
        spark.createDataFrame(posted, "scenario_id STRING, amount_cents INT"),
        spark.createDataFrame([], "scenario_id STRING"),
    )
    got = {r.scenario_id: r for r in replay.compare_replays(expected, totals, details).collect()}
    assert (got["RP-001"].status, got["RP-002"].status) == ("PASS", "PASS")
    assert got["RP-003"].mismatches == [
        "staged count expected 3 but was 4", "rejected count expected 0 but was 1",
        "reconciliation staged_count expected 2 but was 3",
    ]
    assert got["RP-004"].mismatches == ["per-run reconciliation expectations expected true but was false"]
    assert got["RP-002"].expected_summary == (
        "staged=6, posted=6, rejected=0, errors=0, total=63000, per-run staged=3, per-run posted=3, "
        "per-run posted-total=31500, per-run staged-total=31500, aggregateReconRows=2"
    )
    assert got["RP-001"].actual_summary.endswith("reconRows=1, countsMatch=true, totalsMatch=true, perRunMatch=n/a")


def test_incomplete_expectations(spark, tmp_path):
    for broken in ({"purpose": " "}, {"runsSubmitted": 0}, {"expectedStagedCount": None}, {}):
        path = expectation(spark, tmp_path, "RP-9", **broken)
        with pytest.raises(Exception, match="RP-9 lacks"):
            read_expectations(spark, path).collect()
    assert require_expectation_fields(spark.createDataFrame([], EXPECTATION)).count() == 0


def test_suite(spark):
    checks = spark.createDataFrame(
        [("C1", "clean", "PASS", None), ("C1", "negative", "FAIL", "R2"), ("C2", "drift", "PASS", None),
         ("C2", "unseen", "FAIL", "R9")],
        "contract_id STRING, check_id STRING, expected_status STRING, expected_rule STRING",
    )
    hits = spark.createDataFrame(
        [("C1", "negative", "FAIL", "R2"), ("C1", "negative", "WARNING", "R1"), ("C2", "drift", "WARNING", "R1")],
        "contract_id STRING, check_id STRING, severity STRING, rule_id STRING",
    )
    recorded = rollup.record_checks(rollup.check_outcomes(checks, hits))
    got = {r.check_id: (r.status, r.passed, r.actual_outcome) for r in recorded.collect()}
    assert got == {
        "clean": ("PASS", True, "PASS with no violations"),
        "negative": ("PASS", True, "FAIL with violations: R1, R2"),
        "drift": ("WARNING", False, "WARNING with violations: R1"),
        "unseen": ("PASS", False, "PASS with no violations"),
    }
    contracts = rollup.contract_status(recorded)
    assert {r.contract_id: r.status for r in contracts.collect()} == {"C1": "PASS", "C2": "WARNING"}
    replays = spark.createDataFrame([("PASS",), ("FAIL",)], "status STRING")
    suite = rollup.suite_status(contracts, replays).first()
    assert (suite.overall_status, suite.contract_results, suite.replay_results, suite.failed) == ("FAIL", 2, 2, 1)
