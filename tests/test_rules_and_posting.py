import pytest
from pyspark.sql import functions as F

from tillstone.operators.posting import mark_posted, post
from tillstone.operators.validation import (
    Rule, accepted, hold_failed_batches, reject_counts, reject_log, standard_rules, validate,
)
from tillstone.operators import reporting
from tillstone.sources.inbound import read_inbound_csv
from tillstone.sources.tables import latest_status, read_table, scoped

AMOUNT, DIRECTION = "amount must be positive; ", "direction must be D or C; "
MISSING, INACTIVE = "account not found; ", "account is not active; "
COLUMNS = "id INT, batch_id INT, account_id INT, merchant_id INT, direction STRING, amount_cents INT, status STRING"


@pytest.fixture(scope="module")
def accounts(spark):
    return spark.createDataFrame(
        [(2001, "active"), (2002, "closed"), (2004, "frozen")], "account_id INT, status STRING"
    )


def staged(spark, *rows):
    return spark.createDataFrame([(i + 1, 1, a, 3001, d, c, "staged") for i, (a, d, c) in enumerate(rows)], COLUMNS)


@pytest.mark.parametrize(
    "account, direction, cents, message",
    [
        (2001, "D", 1, None),
        (2001, "C ", 5000, None),
        (2001, "D", 0, AMOUNT),
        (2001, "D", -1, AMOUNT),
        (2001, "d", 1, DIRECTION),
        (2001, "X", 1, DIRECTION),
        (2001, "DC", 1, DIRECTION),
        (2001, "", 1, DIRECTION),
        (2001, None, 1, DIRECTION),
        (9999, "D", 1, MISSING),
        (2004, "D", 1, INACTIVE),
        (2002, "D", 1, INACTIVE),
        (9999, "x", 0, AMOUNT + DIRECTION + MISSING),
        (2004, "x", 0, AMOUNT + DIRECTION + INACTIVE),
    ],
)
def test_rules(spark, accounts, account, direction, cents, message):
    row = validate(staged(spark, (account, direction, cents)), accounts).first()
    assert row.error_message == message
    assert row.status == ("rejected" if message else "validated")


def test_extra_rule(spark, accounts):
    rules = [*standard_rules(), Rule("large", F.col("amount_cents") > 1000, "amount is too large; ")]
    row = validate(staged(spark, (9999, "D", 5000)), accounts, rules).first()
    assert row.error_message == MISSING + "amount is too large; "


def test_reject_log_and_posting(spark, accounts):
    outcomes = validate(staged(spark, (2001, "D", 5000), (2001, "D", 0), (2001, "C", 7)), accounts)
    log = reject_log(outcomes, 77).collect()
    assert [(r.batch_job_id, r.error_message, r.record_ref) for r in log] == [(77, AMOUNT, "staged_transactions.id=2")]
    assert accepted(outcomes).count() == 2
    rows = post(outcomes).orderBy("txn_id").collect()
    assert [(r.txn_id, r.amount_cents, r.status, r.description) for r in rows] == [
        (1, 5000, "posted", "Batch posted"), (3, 7, "posted", "Batch posted")
    ]
    assert "txn_date" not in rows[0].asDict()
    states = {r.id: r.status for r in mark_posted(outcomes).collect()}
    assert states == {1: "posted", 2: "rejected", 3: "posted"}
    assert post(outcomes.where("false")).count() == 0


def test_reject_limit(spark, accounts):
    rows = [(i, b, 2001, None, "D", c, "staged") for i, (b, c) in enumerate([(1, 0), (1, 0), (1, 5), (2, 0), (2, 5)])]
    outcomes = validate(spark.createDataFrame(rows, COLUMNS), accounts)
    counts = {r.batch_id: (r.skip_count, r.batch_status) for r in reject_counts(outcomes, 1).collect()}
    assert counts == {1: (2, "failed"), 2: (1, "completed")}
    held = hold_failed_batches(outcomes, 1).orderBy("id").collect()
    assert [r.status for r in held] == ["staged"] * 3 + ["rejected", "validated"]
    assert all(r.error_message is None for r in held[:3])


def test_latest_status_wins(spark):
    first = spark.createDataFrame([(1, "staged"), (2, "staged")], "id INT, status STRING")
    then = spark.createDataFrame([(1, "validated")], "id INT, status STRING")
    last = spark.createDataFrame([(1, "posted")], "id INT, status STRING")
    assert {r.id: r.status for r in latest_status([first, then, last]).collect()} == {1: "posted", 2: "staged"}


def test_csv_scan_binds_by_position(spark, tmp_path):
    (tmp_path / "f.csv").write_text("one,two,three,four,five\n2001,,C,1500,3/7/2025\n# note\n2002,3001,  ,abc,2025-03-10\n")
    rows = read_inbound_csv(spark, str(tmp_path / "f.csv")).orderBy("account_id").collect()
    assert [(r.account_id, r.merchant_id, r.amount_cents, r.txn_date) for r in rows] == [
        (2001, None, 1500, "3/7/2025"), (2002, 3001, None, "2025-03-10")
    ]
    assert rows[0]["_corrupt"] is None and rows[1]["_corrupt"].startswith("2002")
    assert rows[0].file.endswith("/f.csv")


def test_scoped_scan_prunes_and_pushes(spark, tmp_path):
    frame = spark.createDataFrame([(1, "posted", 7), (2, "staged", 8)], "id INT, status STRING, batch_id INT")
    frame.write.partitionBy("batch_id").parquet(str(tmp_path / "t"))
    table = read_table(spark, str(tmp_path), "t", "id INT, status STRING, batch_id INT")
    plan = scoped(table, "posted", 7)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,posted)" in plan and "PartitionFilters: [isnotnull(batch_id" in plan
    assert scoped(table, "posted", 7).count() == 1 and scoped(table, "posted", 8).count() == 0
    assert read_table(spark, str(tmp_path), "none", "id INT").count() == 0


def test_report_sections(spark):
    jobs = spark.createDataFrame(
        [(5, "post", "completed", 0, 2, 10), (1, "load", "completed", 0, 1, 4), (2, "load", "completed", 5, None, 3),
         (3, "load", "failed", 0, 9, 9)],
        "id INT, job_name STRING, status STRING, s INT, f INT, record_count INT",
    ).select("id", "job_name", "status", "record_count", F.timestamp_seconds("s").alias("started_at"),
             F.timestamp_seconds("f").alias("finished_at"))
    rows = reporting.job_totals(jobs).collect()
    assert [(r.job_name, r.status, r.record_count, r.duration_secs) for r in rows] == [
        ("load", "completed", 7, 1.0), ("post", "completed", 10, 2.0)
    ]
    batches = spark.createDataFrame([(1, "a.csv", 2), (2, "b.csv", 0)], "id INT, file_name STRING, record_count INT")
    table = spark.createDataFrame([(1, "posted"), (1, "rejected")], "batch_id INT, status STRING")
    files = reporting.file_summary(batches, table).collect()
    assert [(r.file_name, r.posted, r.rejected, r.still_staged) for r in files] == [("a.csv", 1, 1, 0), ("b.csv", 0, 0, 0)]
    errors = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "error_message STRING")
    assert [tuple(r) for r in reporting.reject_reasons(errors).collect()] == [("b", 2), ("a", 1), ("c", 1)]
    counts = reporting.counts_in_one_row({"x": batches, "y": errors}).first()
    assert (counts.x, counts.y) == (2, 4)


def test_a_row_without_amount_is_rejected_not_posted(spark, accounts):
    judged = validate(staged(spark, (2001, "D", None), (2001, "D", 5)), accounts)
    assert [(r.status, r.error_message) for r in judged.orderBy("id").collect()] == [("rejected", AMOUNT), ("validated", None)]
    assert post(judged).count() == 1 and reject_log(judged).first().error_message == AMOUNT
