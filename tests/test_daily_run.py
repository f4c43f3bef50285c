import pytest
from pyspark.sql import functions as F

from tillstone.model import MERCHANTS
from tillstone.operators.reconciliation import ReconciliationMismatch
from tillstone.operators.intake import batch_key
from tillstone.plans import daily_run as D
from tillstone.sources.tables import write_partitions

HEADER = "account_id,merchant_id,direction,amount_cents,txn_date\n"
VALID = HEADER + "410,71,D,1234,2024-11-05\n411,72,C,866,2024-11-05\n412,,C,7900,2024-11-06\n"
MIXED = HEADER + (
    "410,71,D,333,2024-11-05\n411,72,D,-4,2024-11-05\n412,,C,667,2024-11-07\n"
    "777,71,D,90,2024-11-05\n410,,Q,15,2024-11-06\n"
)


@pytest.fixture(scope="module")
def accounts(spark):
    return spark.createDataFrame(
        [(410, "active"), (411, "active"), (412, "active"), (413, "frozen")], "account_id INT, status STRING"
    )


def key_of(spark, run_id, path):
    return spark.range(1).select(batch_key(run_id, F.lit(f"file://{path}"))).first()[0]


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()

    def drop(name, text):
        path = folder / name
        path.write_text(text)
        return str(path)

    drop.root = str(tmp_path / "store")
    return drop


def test_valid_file(spark, accounts, inbox):
    summary = D.run_batches(spark, inbox.root, inbox("valid.csv", VALID), 1000, accounts)
    totals = summary.totals.first()
    assert (totals.total, totals.posted, totals.rejected, totals.still_staged) == (3, 3, 0, 0)
    row = D.Store(spark, inbox.root).table("batch_reconciliations").first()
    assert (row.staged_count, row.posted_count, row.posted_total_cents) == (3, 3, 10000)
    assert row.counts_match and row.totals_match
    assert [r.result for r in summary.reconciliations.collect()] == ["PASS"]


def test_mixed_file(spark, accounts, inbox):
    summary = D.run_batches(spark, inbox.root, inbox("mixed.csv", MIXED), 1000, accounts)
    totals = summary.totals.first()
    assert (totals.total, totals.posted, totals.rejected) == (5, 2, 3)
    reasons = {r.error_message: r.cnt for r in summary.reject_reasons.collect()}
    assert reasons == {"amount must be positive; ": 1, "account not found; ": 1, "direction must be D or C; ": 1}
    row = D.Store(spark, inbox.root).table("batch_reconciliations").first()
    assert (row.staged_count, row.posted_count, row.staged_total_cents) == (2, 2, 1000)
    jobs = {r.job_name: r.record_count for r in summary.jobs.collect()}
    assert jobs == {"load_transactions": 5, "validate_transactions": 5, "post_transactions": 2, "reconcile_batches": 1}
    assert [r.job_name for r in summary.jobs.collect()] == list(jobs)
    files = summary.files.first()
    assert (files.file_name, files.record_count, files.posted, files.rejected) == ("mixed.csv", 5, 2, 3)


def test_same_file_in_two_runs_is_two_batches(spark, accounts, inbox):
    path = inbox("valid.csv", VALID)
    D.run_batches(spark, inbox.root, path, 1000, accounts)
    summary = D.run_batches(spark, inbox.root, path, 2000, accounts)
    rows = D.Store(spark, inbox.root).table("batch_reconciliations").orderBy("batch_id").collect()
    assert [(r.staged_count, r.posted_count, r.posted_total_cents) for r in rows] == [(3, 3, 10000)] * 2
    assert summary.totals.first().total == 6


def test_repeating_a_run_changes_nothing(spark, accounts, inbox):
    path = inbox("mixed.csv", MIXED)
    D.run_batches(spark, inbox.root, path, 1000, accounts)
    store = D.Store(spark, inbox.root)
    before = sorted(map(tuple, store.table("transactions").collect()), key=str)
    summary = D.run_batches(spark, inbox.root, path, 1000, accounts)
    assert sorted(map(tuple, store.table("transactions").collect()), key=str) == before
    assert summary.totals.first().total == 5
    assert store.table("stage_runs").count() == 4


def test_lost_ledger_row_stops_the_run_after_the_report(spark, accounts, inbox, monkeypatch):
    real = D.post
    monkeypatch.setattr(D, "post", lambda rows: real(rows.where(F.col("account_id") != 411)))
    with pytest.raises(ReconciliationMismatch) as stopped:
        D.run_batches(spark, inbox.root, inbox("valid.csv", VALID), 1000, accounts)
    assert [r.result for r in stopped.value.summary.reconciliations.collect()] == ["FAIL"]
    row = D.Store(spark, inbox.root).table("batch_reconciliations").first()
    assert (row.staged_count, row.posted_count, row.counts_match, row.totals_match) == (3, 2, False, False)


def test_reject_limit_holds_the_batch(spark, accounts, inbox):
    paths = [inbox("mixed.csv", MIXED), inbox("valid.csv", VALID)]
    with pytest.raises(D.StageFailed):
        D.run_batches(spark, inbox.root, paths, 1000, accounts, limit=2)
    states = D.Store(spark, inbox.root).table("outcomes").groupBy("batch_id", "status").count().collect()
    assert {(r.batch_id, r.status): r["count"] for r in states} == {
        (key_of(spark, 1000, paths[0]), "staged"): 5, (key_of(spark, 1000, paths[1]), "validated"): 3
    }


def test_pending_rows_of_a_failed_run(spark, accounts, inbox):
    store = D.Store(spark, inbox.root)
    D.load(store, inbox("late.csv", VALID), 1000)
    assert store.table("intake").count() == 3
    path = inbox("mixed.csv", MIXED)
    summary = D.run_batches(spark, inbox.root, path, 2000, accounts, all_pending=True)
    assert summary.totals.first().posted == 5
    rows = store.table("batch_reconciliations").collect()
    assert [r.batch_id for r in rows] == [key_of(spark, 2000, path)]


def test_equal_names_in_two_folders_are_two_batches(spark, accounts, inbox, tmp_path):
    paths = []
    for folder, cents in (("east", 41), ("west", 62)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.csv").write_text(HEADER + f"410,,D,{cents},2025-03-10\n")
        paths.append(str(tmp_path / folder / "x.csv"))
    D.run_batches(spark, inbox.root, paths[:1], 1000, accounts)
    summary = D.run_batches(spark, inbox.root, paths, 1000, accounts)
    assert [(r.file_name, r.record_count, r.posted) for r in summary.files.collect()] == [("x.csv", 1, 1)] * 2
    store = D.Store(spark, inbox.root)
    assert sorted(r.amount_cents for r in store.table("transactions").collect()) == [41, 62]
    assert store.table("batch_reconciliations").count() == 2
    # Both in one call of another run.
    D.run_batches(spark, inbox.root, paths, 2000, accounts)
    again = store.table("transactions", 2000)
    assert sorted(r.amount_cents for r in again.collect()) == [41, 62]
    assert again.select("batch_id").distinct().count() == 2


def test_file_without_rows(spark, accounts, inbox):
    paths = [inbox("none.csv", HEADER), inbox("valid.csv", VALID), inbox("empty.csv", "")]
    summary = D.run_batches(spark, inbox.root, paths, 1000, accounts)
    files = {r.file_name: (r.record_count, r.posted) for r in summary.files.collect()}
    assert files == {"none.csv": (0, 0), "valid.csv": (3, 3), "empty.csv": (0, 0)}


def test_lines_that_cannot_be_staged(spark, accounts, inbox):
    merchants = spark.createDataFrame([(71, "a", "b", None), (72, "c", "d", None)], MERCHANTS)
    text = HEADER + (
        "410,71,D,5000,3/7/2025\r\n"
        "410,71,D,abc,2025-03-10\r\n"
        "# remark\r\n"
        "\r\n"
        "410,71,DR,1,2025-03-10\r\n"
        "410,71,D,1\r\n"
        "410,79,D,1,2025-03-10\r\n"
        "410,71,D,1,yesterday\r\n"
        "777,,  ,0,2025-03-10\r\n"
    )
    store = D.Store(spark, inbox.root)
    path = inbox("odd.csv", text)
    D.load(store, path, 1000, merchants)
    rows = store.table("intake").orderBy("row_no").collect()
    assert [(r.row_no, r.problem) for r in rows] == [
        (2, None), (3, "amount_cents is not an integer"), (6, "direction is longer than one character"),
        (7, "wrong number of cells"), (8, "merchant does not exist"), (9, "txn_date is not a date"), (10, None),
    ]
    assert str(rows[0].txn_date) == "2025-03-07" and rows[0].id == key_of(spark, 1000, path) + ":2"
    assert rows[-1].direction == "" and rows[-1].merchant_id is None


def test_partition_writes_replace_only_their_own(spark, tmp_path):
    root = str(tmp_path)
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "v INT, batch_id STRING")
    write_partitions(frame, root, "t", ["batch_id"])
    write_partitions(frame.where("batch_id = 'a'").withColumn("v", F.lit(9)), root, "t", ["batch_id"])
    assert sorted(map(tuple, spark.read.parquet(f"{root}/t").collect())) == [(2, "b"), (9, "a")]


def test_a_stage_that_dies_leaves_a_failed_control_row(spark, tmp_path):
    store = D.Store(spark, str(tmp_path / "store"))
    seen = []
    with pytest.raises(ZeroDivisionError):
        with store.stage(7, "load_transactions") as done:
            seen += [(r.status, r.finished_at) for r in store.table("stage_runs").collect()]
            done["count"] = 3 // 0
    assert seen == [("running", None)]
    (row,) = store.table("stage_runs").collect()
    assert (row.run_id, row.status, row.record_count) == (7, "failed", None) and row.finished_at is not None


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_store_is_bucketed_and_reads_are_pruned(spark, accounts, inbox, tmp_path):
    paths = [inbox(f"f{i}.csv", HEADER + f"410,,D,{100 + i},2025-03-10\n") for i in range(90)]
    D.run_batches(spark, inbox.root, paths, 1000, accounts)
    store = D.Store(spark, inbox.root)
    folders = list((tmp_path / "store" / "transactions" / "run_id=1000").glob("bucket=*"))
    assert 20 < len(folders) <= D.BUCKETS and store.table("transactions").count() == 90
    key = key_of(spark, 1000, paths[7])
    one = store.table("outcomes", 1000, key)
    assert [r.amount_cents for r in one.collect()] == [107]
    (filters,) = [line for line in plan_of(one).splitlines() if "PartitionFilters" in line]
    assert "run_id" in filters.split("PartitionFilters")[1].split("]")[0] and "bucket" in filters.split("PartitionFilters")[1].split("]")[0]
    assert len(one.inputFiles()) >= 1
    some = store.table("batches").where(F.col("id").isin(key, key_of(spark, 1000, paths[8])))
    several = store.of_batches("outcomes", some)
    assert sorted(r.amount_cents for r in several.collect()) == [107, 108]
    assert "dynamicpruning" in plan_of(several).lower()


def test_counts_are_taken_while_writing(spark, tmp_path):
    from tillstone.sources.tables import write_under

    frame = spark.range(0, 1000, 1, 5).withColumn("batch_id", F.lit("a"))
    root = str(tmp_path / "t")
    for gather in (False, True):
        assert write_under(frame, root, "x", {"run_id": 1}, ["batch_id"], gather, F.col("id") % 2 == 0) == 500
        assert write_under(frame, root, "x", {"run_id": 1}, ["batch_id"], gather) == 1000
    assert spark.read.parquet(f"{root}/x").count() == 1000
    assert write_under(frame.where("id < 0"), root, "x", {"run_id": 2}, ["batch_id"]) == 0
    assert write_partitions(frame.limit(0), root, "y", ["batch_id"]) == 0


def test_files_that_come_later_are_a_second_load(spark, accounts, inbox):
    first = inbox("a.csv", VALID)
    D.run_batches(spark, inbox.root, first, 1000, accounts)
    both = [first, inbox("b.csv", MIXED)]
    summary = D.run_batches(spark, inbox.root, both, 1000, accounts)
    store = D.Store(spark, inbox.root)
    assert summary.totals.first().total == 8 and store.stored("batches").agg(F.max("load")).first()[0] == 1
    assert {r.job_name: r.record_count for r in summary.jobs.collect()}["load_transactions"] == 8


def test_only_buckets_of_a_held_batch_are_written_again(spark, accounts, inbox, tmp_path):
    paths = [inbox(f"v{i}.csv", VALID) for i in range(12)] + [inbox("mixed.csv", MIXED)]
    store = D.Store(spark, inbox.root)
    D.load(store, paths, 1000)
    with pytest.raises(D.StageFailed):
        D.validate_run(store, 1000, accounts, limit=2)
    assert store.table("outcomes").where("status = 'validated'").count() == 36
    assert store.table("outcomes").where("status = 'staged'").count() == 5
    assert store.table("batch_job_errors").count() == 0
    files = {f.parent.name: f.name.split("-")[1:6] for f in (tmp_path / "store" / "outcomes" / "run_id=1000").glob("bucket=*/*.parquet")}
    bucket = spark.range(1).select(D.bucket_of(F.lit(key_of(spark, 1000, paths[-1])))).first()[0]
    writes = [tuple(v[1:]) for k, v in files.items() if k != f"bucket={bucket}"]
    assert len(set(writes)) == 1 and tuple(files[f"bucket={bucket}"][1:]) not in writes
