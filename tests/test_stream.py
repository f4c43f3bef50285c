import pytest
from pyspark.sql import functions as F

from tillstone.operators.reconciliation import reconcile
from tillstone.streaming.intake_stream import intake_folder

HEADER = "account_id,merchant_id,direction,amount_cents,txn_date\n"


@pytest.fixture(scope="module")
def accounts(spark):
    return spark.createDataFrame([(2001, "active"), (2004, "frozen")], "account_id INT, status STRING")


def state(spark, root):
    table = spark.read.parquet(f"{root}/staged_transactions")
    ledger = spark.read.parquet(f"{root}/transactions")
    return {r.batch_id.rsplit("-", 1)[0]: (r.staged_count, r.posted_count, r.posted_total_cents) for r in reconcile(table, ledger).collect()}


def test_each_file_once_and_repeats_are_harmless(spark, accounts, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    (inbox / "a.csv").write_text(HEADER + "2001,,D,5,2025-03-10\n2004,,D,7,2025-03-10\nbroken\n")
    intake_folder(spark, str(inbox), accounts, root)
    assert state(spark, root) == {"a.csv": (1, 1, 5)}
    (inbox / "b.csv").write_text(HEADER + "2001,,C,100,2025-03-11\n2001,3001,C,11,2025-03-11\n")
    intake_folder(spark, str(inbox), accounts, root)
    assert state(spark, root) == {"a.csv": (1, 1, 5), "b.csv": (2, 2, 111)}
    intake_folder(spark, str(inbox), accounts, root)
    assert state(spark, root) == {"a.csv": (1, 1, 5), "b.csv": (2, 2, 111)}
    rows = spark.read.parquet(f"{root}/staged_transactions").orderBy("id").select("id", "status").collect()
    assert [(r.id.rsplit("-", 1)[0] + r.id[r.id.rindex(":"):], r.status) for r in rows] == [
        ("a.csv:2", "posted"), ("a.csv:3", "rejected"), ("b.csv:2", "posted"), ("b.csv:3", "posted")
    ]
    lost = spark.read.parquet(f"{root}/quarantine").first()
    assert (lost.row_no, lost.line, lost.problem) == (4, "broken", "wrong number of cells")

    # A replay that lost its progress takes both files again and leaves the same tables.
    moved = str(tmp_path / "again")
    for name in ("staged_transactions", "transactions"):
        spark.read.parquet(f"{root}/{name}").write.partitionBy("file_key").parquet(f"{moved}/{name}")
    intake_folder(spark, str(inbox), accounts, moved)
    assert state(spark, moved) == state(spark, root)
    assert spark.read.parquet(f"{moved}/transactions").agg(F.sum("amount_cents")).first()[0] == 116


def test_equal_names_in_two_folders(spark, accounts, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    for folder, cents in (("east", 41), ("west", 62)):
        (inbox / folder).mkdir(parents=True)
        (inbox / folder / "x.csv").write_text(HEADER + f"2001,,D,{cents},2025-03-10\n")
        intake_folder(spark, str(inbox / "*"), accounts, root)
    ledger = spark.read.parquet(f"{root}/transactions")
    assert sorted(r.amount_cents for r in ledger.collect()) == [41, 62]
