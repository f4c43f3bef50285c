import json

import pytest
from pyspark.sql import functions as F

from tillstone.model import APPROVALS
from tillstone.operators import baseline as B
from tillstone.operators.posting import mark_posted, post
from tillstone.operators.reconciliation import collect_outputs, reconcile
from tillstone.operators.validation import reject_log, standard_rules, validate
from tillstone.sources.documents import read_approvals, read_baselines, with_approval_defaults
from tillstone.sources.tables import as_json, write_json

ACCOUNTS = [(2001, "active"), (2002, "active"), (2003, "active"), (2004, "frozen")]
ROWS = {
    "ds-001": [(2001, "D", 5000), (2002, "C", 1500), (2003, "C", 25000)],
    "ds-002": [(2001, "D", 10001), (2002, "C", 20000), (2003, "C", 30002), (2001, "D", 7778)],
    "ds-003": [(2001, "D", 5000), (2002, "C", 3000), (2003, "C", 8000), (2001, "d", 2000)],
}
GOLDEN = {
    "ds-001": (ROWS["ds-001"][::-1], "Batch  posted"),
    "ds-002": ([(2001, "D", 10000), (2002, "C", 20000), (2003, "C", 30000), (2001, "D", 7777)], "Batch posted"),
    "ds-003": ([(2001, "D", 5000), (2002, "C", 3000), (2003, "C", 8000), (2001, "D", 2000)], "Batch posted"),
}


@pytest.fixture(scope="module")
def actual(spark):
    rows = [
        (f"{ds}-{i}", ds, ds, a, None, d, c) for ds, members in ROWS.items() for i, (a, d, c) in enumerate(members)
    ]
    staged = spark.createDataFrame(
        rows, "id STRING, batch_id STRING, dataset_id STRING, account_id INT, merchant_id INT, direction STRING, "
              "amount_cents INT"
    ).withColumn("status", F.lit("staged"))
    outcomes = validate(staged, spark.createDataFrame(ACCOUNTS, "account_id INT, status STRING"))
    table, ledger = mark_posted(outcomes), post(outcomes)
    recon = reconcile(table, ledger).withColumn("dataset_id", F.col("batch_id"))
    return collect_outputs(table, ledger, reject_log(outcomes), recon)


@pytest.fixture(scope="module")
def golden(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("golden")
    for ds, (rows, text) in GOLDEN.items():
        (folder / f"{ds}.json").write_text(json.dumps({
            "datasetId": ds, "description": ds, "stagedCount": len(rows), "postedCount": len(rows),
            "rejectedCount": 0, "errorCount": 0, "totalPostedCents": sum(r[2] for r in rows),
            "reconciliation": {"countsMatch": True, "totalsMatch": True},
            "transactions": [
                {"accountId": a, "merchantId": None, "direction": d, "amountCents": c, "description": text}
                for a, d, c in rows
            ],
            "errors": [],
        }, indent=1))
    return B.baseline_outputs(read_baselines(spark, str(folder)))


def approvals(spark, *entries):
    names = ["dataset_id", "entry_ord", "field", "expectedValue", "actualValue", "matchType", "approvedBy", "rationale"]
    rows = [tuple(e.get(n) for n in names) for e in entries]
    frame = spark.createDataFrame(
        rows, "dataset_id STRING, entry_ord INT, field STRING, expectedValue STRING, actualValue STRING, "
              "matchType STRING, approvedBy STRING, rationale STRING"
    )
    return with_approval_defaults(frame)


def test_golden_datasets(spark, actual, golden):
    findings, results = B.verify(actual, golden, approvals(spark))
    got = {r.dataset_id: (r.overall_status, r.pass_count, r.fail_count) for r in results.collect()}
    assert got == {"ds-001": ("PASS", 14, 0), "ds-002": ("FAIL", 13, 4), "ds-003": ("FAIL", 1, 4)}
    fields = {}
    for row in findings.collect():
        fields.setdefault(row.dataset_id, {})[row.field] = (row.expected, row.actual)
    assert fields == {
        "ds-002": {
            "totalPostedCents": ("67777", "67781"), "transactions[0].amountCents": ("7777", "7778"),
            "transactions[1].amountCents": ("10000", "10001"), "transactions[3].amountCents": ("30000", "30002"),
        },
        "ds-003": {
            "postedCount": ("4", "3"), "rejectedCount": ("0", "1"), "errorCount": ("0", "1"),
            "totalPostedCents": ("18000", "16000"),
        },
    }


def test_collected_metrics(actual):
    row = actual.metrics.where("dataset_id = 'ds-003'").first()
    assert (row.staged_count, row.posted_count, row.rejected_count, row.error_count, row.total_posted_cents) == (
        4, 3, 1, 1, 16000
    )
    assert row.counts_match and row.totals_match


def compared(spark, field, expected, actual):
    return spark.createDataFrame(
        [("d", field, expected, actual, False)],
        "dataset_id STRING, field STRING, expected STRING, actual STRING, equal BOOLEAN",
    )


@pytest.mark.parametrize(
    "signer, outcome", [("a.reviewer", "APPROVED_DIFFERENCE"), ("", "WARNING"), ("  ", "WARNING"), (None, "WARNING")]
)
def test_exact_approvals(spark, signer, outcome):
    field = "transactions[0].amountCents"
    entry = {"dataset_id": "d", "entry_ord": 1, "field": field, "expectedValue": "10000", "actualValue": "10001",
             "approvedBy": signer, "rationale": "rounding"}
    found = B.classify(compared(spark, field, "10000", "10001"), approvals(spark, entry)).first()
    assert (found.classification, found.rationale) == (outcome, "rounding")
    other = B.classify(compared(spark, field, "10000", "10002"), approvals(spark, entry)).first()
    assert (other.classification, other.rationale) == ("FAIL", None)


def test_contained_texts_and_first_match(spark):
    field = "errors[0].errorMessage"
    frame = compared(spark, field, "ERR_ACCT_INACTIVE", "account is not active;")
    entries = [
        {"dataset_id": "d", "entry_ord": 1, "field": field, "expectedValue": "OTHER", "actualValue": "", "approvedBy": "x",
         "matchType": "contains", "rationale": "one"},
        {"dataset_id": "d", "entry_ord": 3, "field": field, "expectedValue": "ERR", "actualValue": "account",
         "matchType": "contains", "rationale": "three"},
        {"dataset_id": "d", "entry_ord": 2, "field": field, "expectedValue": "ERR_ACCT_INACTIVE",
         "actualValue": "account is not active", "approvedBy": "b.reviewer", "matchType": "contains",
         "rationale": "two"},
        {"dataset_id": "e", "entry_ord": 0, "field": field, "matchType": "contains", "rationale": "elsewhere"},
    ]
    found = B.classify(frame, approvals(spark, *entries)).first()
    assert (found.classification, found.rationale) == ("APPROVED_DIFFERENCE", "two")
    gap = B.classify(compared(spark, field, "ERR", None), approvals(spark, entries[1])).first()
    assert gap.classification == "WARNING"


def test_approval_file_may_be_absent(spark, tmp_path):
    assert read_approvals(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "a.json").write_text('{"dataset_id": "d", "entry_ord": 1, "field": "postedCount"}\n')
    row = read_approvals(spark, str(tmp_path / "a.json")).first()
    assert (row.expectedValue, row.actualValue, row.matchType) == ("", "", "exact")
    assert spark.createDataFrame([], APPROVALS).columns == list(row.asDict())


def test_rows_without_counterpart_are_reported(spark, actual, golden):
    """A ledger shorter than the posted count leaves findings, not silence."""
    short = actual._replace(transactions=actual.transactions.where("ref <> 'ds-001-1'"))
    fields = B.compare_fields(short, golden).where("dataset_id = 'ds-001' AND NOT equal")
    assert fields.where("actual IS NULL").count() == 3


def test_message_pairs_go_as_far_as_both_lists(spark, actual, golden):
    texts = [("ds-003", "account  is not active; ", "r1"), ("ds-003", None, "r2")]
    wanted = golden._replace(errors=spark.createDataFrame(texts, actual.errors.schema))
    got = B.compare_fields(actual, wanted).where("field LIKE 'errors%'").collect()
    assert [(r.field, r.expected, r.actual) for r in got] == [
        ("errors[0].errorMessage", None, "direction must be D or C;")
    ]


def test_legacy_rules_take_lower_case(spark):
    staged = spark.createDataFrame([(1, 2001, "d", 5)], "id INT, account_id INT, direction STRING, amount_cents INT")
    accounts = spark.createDataFrame(ACCOUNTS, "account_id INT, status STRING")
    assert validate(staged, accounts).first().status == "rejected"
    assert validate(staged, accounts, standard_rules(fold_direction=True)).first().status == "validated"


def test_report_sinks(spark, tmp_path, actual, golden):
    results = B.verify(actual, golden, approvals(spark))[1].orderBy("dataset_id")
    write_json(results, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 3
    first = json.loads(as_json(results).first().json)
    assert first["dataset_id"] == "ds-001" and first["pass_count"] == 14


def test_report_lists_findings_in_numbered_parts(spark, actual, golden):
    classified, results = B.verify(actual, golden, approvals(spark))
    named = spark.createDataFrame([("ds-002", "mixed rows")], "dataset_id STRING, description STRING")
    made = B.report(results, classified, named, {"commit": "abc", "environment": "test"}, 3)
    rows = sorted((json.loads(r.json) for r in as_json(made).collect()), key=lambda r: (r["dataset_id"], r["part"]))
    assert [(r["dataset_id"], r["part"], r["parts"], len(r["discrepancies"])) for r in rows] == [
        ("ds-001", 0, 1, 0), ("ds-002", 0, 2, 3), ("ds-002", 1, 2, 1), ("ds-003", 0, 2, 3), ("ds-003", 1, 2, 1)
    ]
    assert all((r["commit"], r["environment"]) == ("abc", "test") for r in rows)
    assert [r["description"] for r in rows] == [None, "mixed rows", "mixed rows", None, None]
    fields = [d["field"] for r in rows for d in r["discrepancies"] if r["dataset_id"] == "ds-002"]
    want = {r.field for r in classified.where("dataset_id = 'ds-002'").collect()}
    assert set(fields) == want and len(fields) == 4
    names = [n for n, _ in B.SCALAR_FIELDS]
    scalars = [f for f in fields if f in names]
    assert fields[: len(scalars)] == scalars == sorted(scalars, key=names.index)


def test_pairing_reads_one_layout_and_joins_nothing(spark, actual, golden):
    plan = B.compare_fields(actual, golden)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 4 and plan.count("idx") and "Join LeftOuter" not in plan
