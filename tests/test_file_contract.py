import pytest
from pyspark.sql import functions as F

from tillstone.operators import file_contract as C
from tillstone.model import INBOUND_CONTRACT
from tillstone.sources.documents import read_file_contract
from tillstone.sources.inbound import list_files, number_lines, read_line_blocks

HEADER = "account_id,merchant_id,direction,amount_cents,txn_date\n"
ROW = "880415,606,D,73,2023-07-19\n"

CASES = [
    ("valid", HEADER + ROW, "PASS", set()),
    ("blank", "   ", "FAIL", {"ACH-FILE-001-EMPTY"}),
    ("zero", "", "FAIL", {"ACH-FILE-001-EMPTY"}),
    ("tabs", (HEADER + ROW).replace(",", "\t"), "FAIL", {"ACH-FILE-001-DELIM"}),
    ("first line blank", "\n" + HEADER + ROW, "FAIL", {"ACH-FILE-001-DELIM"}),
    ("missing", "account_id,merchant_id,direction,amount_cents\n2001,x,D,73\n", "FAIL",
     {"ACH-FILE-001-COL-MISSING"}),
    ("renamed", "account_id,merchant_id,direction,amount,txn_date\n" + ROW, "FAIL",
     {"ACH-FILE-001-COL-MISSING", "ACH-FILE-001-COL-EXTRA"}),
    ("extra", HEADER.strip() + ",notes\n" + ROW.strip() + ",ok\n", "WARNING", {"ACH-FILE-001-COL-EXTRA"}),
    ("swapped", "account_id,merchant_id,direction,txn_date,amount_cents\n2001,606,D,2023-07-19,73\n", "WARNING",
     {"ACH-FILE-001-COL-ORDER"}),
    ("amount text", HEADER + "880415,606,D,much,2023-07-19\n", "FAIL", {"ACH-FILE-001-TYPE-AMOUNT"}),
    ("amount decimal", HEADER + "880415,606,D,7.0,2023-07-19\n", "FAIL", {"ACH-FILE-001-TYPE-AMOUNT"}),
    ("date", HEADER + "880415,606,D,73,19.07.2023\n", "FAIL", {"ACH-FILE-001-TYPE-DATE"}),
    ("direction", HEADER + "880415,606,DR,73,2023-07-19\n", "FAIL", {"ACH-FILE-001-ALLOWED-DIR"}),
    ("lower case", HEADER + "880415,606,d,73,2023-07-19\n", "FAIL", {"ACH-FILE-001-ALLOWED-DIR"}),
    ("merchant", HEADER + ROW + "880416,shop,C,12,2023-07-19\n", "FAIL", {"ACH-FILE-001-TYPE-MERCHANT"}),
    ("amount zero", HEADER + "880415,606,D,0,2023-07-19\n", "FAIL", {"ACH-FILE-001-MIN-AMOUNT"}),
    ("no merchant", HEADER + "880415,,D,73,2023-07-19\n", "PASS", set()),
    ("no account", HEADER + " ,606,D,73,2023-07-19\n", "FAIL", {"ACH-FILE-001-NULL-ACCOUNT"}),
    ("short", HEADER + "880415,606,X\n", "FAIL", {"ACH-FILE-001-ROW-SHORT", "ACH-FILE-001-ALLOWED-DIR"}),
    ("long", HEADER + ROW.strip() + ",more,cells\n", "PASS", set()),
    ("crlf", (HEADER + ROW).replace("\n", "\r\n"), "PASS", set()),
    ("gap", HEADER + "\n" + ROW + "\n\n", "PASS", set()),
    ("header only", HEADER, "PASS", set()),
    ("padded", HEADER.replace(",", " , ") + ROW.replace(",", "\t, "), "PASS", set()),
    ("extra and bad row", HEADER.strip() + ",notes\n2001,606,D,0,2023-07-19,ok\n", "FAIL",
     {"ACH-FILE-001-COL-EXTRA", "ACH-FILE-001-MIN-AMOUNT"}),
]


def _verdicts(files, findings):
    rules = {}
    for row in findings.collect():
        rules.setdefault(row.subject, set()).add(row.rule_id)
    return {r.file: (r.status, rules.get(r.file, set())) for r in C.file_status(files, findings).collect()}


def test_contents(spark):
    frame = spark.createDataFrame([(n, t) for n, t, *_ in CASES] + [("null", None)], "file STRING, content STRING")
    got = _verdicts(frame, C.check_contents(frame))
    assert got == {n: (s, r) for n, _, s, r in CASES} | {"null": ("FAIL", {"ACH-FILE-001-EMPTY"})}


def test_files_on_storage(spark, tmp_path):
    for name, text, *_ in CASES:
        (tmp_path / f"{name.replace(' ', '_')}.csv").write_bytes(text.encode())
    files = list_files(spark, str(tmp_path))
    got = _verdicts(files, C.check_files(spark, str(tmp_path)))
    named = {f.rsplit("/", 1)[1][:-4]: v for f, v in got.items()}
    assert named == {n.replace(" ", "_"): (s, r) for n, _, s, r in CASES}


def test_numbered_lines(spark):
    rows = [(n, i + 1, line) for n, t, *_ in CASES if t for i, line in enumerate(t.split("\n"))]
    frame = spark.createDataFrame(rows, "file STRING, row_no BIGINT, value STRING")
    got = _verdicts(frame.select("file").distinct(), C.check_lines(frame))
    assert got == {n: (s, r) for n, t, s, r in CASES if t}


def test_messages(spark):
    frame = spark.createDataFrame([("f", HEADER + ROW + "880416,shop,C,12,2023-07-19\n")], "file STRING, content STRING")
    row = C.check_contents(frame).first()
    assert row.row_no == 3
    assert row.description == "merchant_id is not a valid integer in row 3: 'shop'"
    assert (row.expected, row.actual) == ("type: INTEGER", "row 3 value: shop")


def test_contract_metadata_problems(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '{"contractId": "X-1", "delimiter": "|", "columns": ['
        '{"name": "n", "position": 0, "type": "INTEGER", "constraints": {"minimum": "low"}},'
        '{"name": "d", "position": 1, "type": "DATE", "format": "DD.MM.YYYY"},'
        '{"name": "u", "position": 2, "type": "COLOUR"}]}'
    )
    contract = read_file_contract(spark, str(tmp_path / "c.json"))
    frame = spark.createDataFrame([("f", "n|d|u\n5|1.1.2025|blue\n")], "file STRING, content STRING")
    rules = {r.rule_id for r in C.check_contents(frame, contract).collect()}
    assert rules == {"X-1-SETUP-N", "X-1-SETUP-D"}


def test_unusable_contract_documents(spark, tmp_path):
    (tmp_path / "broken.json").write_text("{")
    with pytest.raises(ValueError):
        read_file_contract(spark, str(tmp_path / "broken.json"))
    with pytest.raises(Exception):
        read_file_contract(spark, str(tmp_path / "absent.json"))
    assert [c["name"] for c in INBOUND_CONTRACT["columns"]][0] == "account_id"


def test_line_numbers_over_many_splits(spark, tmp_path):
    """A file cut into many splits keeps its physical line numbers, next to small files in one split."""
    sizes = {"big": 20_000, "mid": 700, "one": 1}
    for name, n in sizes.items():
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}-{i}{'x' * (i % 37)}\r\n" for i in range(1, n + 1)))
    (tmp_path / "open_end.txt").write_text("open_end-1\nopen_end-2")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        source = read_line_blocks(spark, str(tmp_path))
        assert source.blocks.count() > 20
        numbered = number_lines(source)
        wrong = numbered.where(
            F.col("row_no") != F.regexp_extract("value", r"-(\d+)", 1).cast("bigint")
        )
        assert wrong.count() == 0
        assert numbered.count() == sum(sizes.values()) + 2
        opening = source.blocks.where("block = 0").select("header").collect()
        assert {r.header.split("-")[1][:1] for r in opening} == {"1"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_changed_splits_fail_the_job(spark, tmp_path):
    (tmp_path / "f.txt").write_text("".join(f"line-{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        numbered = number_lines(read_line_blocks(spark, str(tmp_path)))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        with pytest.raises(Exception, match="splits changed"):
            numbered.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
