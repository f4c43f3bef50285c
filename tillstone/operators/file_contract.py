"""File-shape contract: header and cell checks on delimited files."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.scalars import (
    control_trim,
    explode_findings,
    finding,
    is_blank,
    strict_date,
    strict_int,
    worst,
)
from tillstone.model import CONTRACT_SEVERITIES, INBOUND_CONTRACT, RULE_SUFFIX
from tillstone.operators.lookups import lookup_join
from tillstone.session import cut_lineage
from tillstone.sources.inbound import LineBlocks, list_files, number_lines, read_line_blocks
Check = tuple[Column, Column]


class Cell(NamedTuple):
    text: Column
    blank: Column
    parsed: Column


def _say(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _names(contract: dict) -> list[str]:
    return [c["name"] for c in contract["columns"]]


def _delimiter(contract: dict) -> str:
    return contract.get("delimiter", ",")


def _cells(line: Column, contract: dict) -> Column:
    return F.transform(F.split(line, re.escape(_delimiter(contract))), control_trim)


def _rule(contract: dict, kind: str, column: str) -> Column:
    return F.lit(f"{contract['contractId']}-{kind}-{RULE_SUFFIX.get(column, column.upper())}")


def header_layout(header: Column, contract: dict = INBOUND_CONTRACT) -> Column:
    """Header width and the place of each contracted column; null when data rows are not to be checked."""
    heads = _cells(control_trim(header), contract)
    usable = control_trim(header).contains(_delimiter(contract))
    for name in _names(contract):
        usable = usable & F.array_contains(heads, name)
    places = F.array(*[(F.array_position(heads, name) - 1).cast("int") for name in _names(contract)])
    return F.when(usable, F.struct(F.size(heads).alias("width"), places.alias("places")))


def header_findings(heads: DataFrame, contract: dict = INBOUND_CONTRACT) -> DataFrame:
    """Findings on file level; `heads` has file, header and has_text, one row per file.

    An empty file or a header without the delimiter stops all later checks of that file.
    """
    ident, delimiter, names = contract["contractId"], _delimiter(contract), _names(contract)
    subject, first = F.col("file"), control_trim(F.col("header"))
    filled = F.coalesce(F.col("has_text"), F.lit(False))
    split_ok = first.contains(delimiter)
    cells = _cells(first, contract)
    checked = heads.select("file", "header", filled.alias("filled"), split_ok.alias("split_ok"), cells.alias("cells"))
    go_on = F.col("filled") & F.col("split_ok")

    found = [
        F.when(~F.col("filled"), finding(
            subject, F.lit(f"{ident}-EMPTY"), "FAIL", F.lit("File is empty — header row required"),
            F.lit("header row present"), F.lit("empty file"))),
        F.when(F.col("filled") & ~F.col("split_ok"), finding(
            subject, F.lit(f"{ident}-DELIM"), "FAIL",
            F.lit("File does not appear to use the contracted delimiter — header does not contain "
                  f"'{delimiter}'"),
            F.lit(f"delimiter: {delimiter}"), F.lit("delimiter missing from header"))),
    ]
    for column in contract["columns"]:
        name, wanted = column["name"], column["position"]
        place = (F.array_position(F.col("cells"), name) - 1).cast("int")
        found.append(F.when(go_on & (place < 0), finding(
            subject, F.lit(f"{ident}-COL-MISSING"), "FAIL", F.lit(f"Required column missing from header: {name}"),
            F.lit(f"column present: {name}"), F.lit("column absent"))))
        found.append(F.when(go_on & (place >= 0) & (place != wanted), finding(
            subject, F.lit(f"{ident}-COL-ORDER"), "WARNING",
            _say(f"Column '{name}' is at position ", place, f" but contract requires position {wanted}"),
            F.lit(f"position {wanted}"), _say("position ", place))))

    known = F.array(*[F.lit(n) for n in names])
    extra = checked.where(go_on).select(
        "file", F.explode(F.filter("cells", lambda c: ~F.array_contains(known, c))).alias("name")
    ).select(finding(
        subject, F.lit(f"{ident}-COL-EXTRA"), "WARNING",
        _say("Unexpected column in header: '", F.col("name"), "' — not in contract definition"),
        F.lit("columns: [" + ", ".join(names) + "]"), _say("extra column: ", F.col("name"))).alias("f")
    ).select("f.*")
    return explode_findings(checked, found).unionByName(extra)


def _parsed(column: dict, value: Column) -> Column:
    """The typed value of a cell, null when it does not parse."""
    kind = str(column.get("type", "")).upper()
    if kind == "INTEGER":
        return strict_int(value)
    if kind == "DATE" and column.get("format", "YYYY-MM-DD") == "YYYY-MM-DD":
        return strict_date(value)
    return value


def _integer_checks(contract: dict, column: dict, cell: Cell, row: Column, subject: Column) -> list[Check]:
    name = column["name"]
    checks = [(cell.parsed.isNull(), finding(
        subject, _rule(contract, "TYPE", name), "FAIL",
        _say(f"{name} is not a valid integer in row ", row, ": '", cell.text, "'"),
        F.lit("type: INTEGER"), _say("row ", row, " value: ", cell.text)))]
    limits = column.get("constraints") or {}
    if "minimum" in limits:
        least = limits["minimum"]
        whole = isinstance(least, int) and not isinstance(least, bool) and -2**31 <= least < 2**31
        if whole:
            checks.append((cell.parsed < least, finding(
                subject, _rule(contract, "MIN", name), "FAIL",
                _say(f"{name} is below the minimum value in row ", row, ": '", cell.text, "'"),
                F.lit(f"minimum: {least}"), _say("row ", row, " value: ", cell.parsed))))
        else:
            shown = json.dumps(least)
            checks.append((cell.parsed.isNotNull(), finding(
                subject, _rule(contract, "SETUP", name), "FAIL",
                F.lit(f"Contract metadata for {name} has a non-integer 'minimum' constraint: {shown}"),
                F.lit("integer minimum constraint"), F.lit(f"minimum: {shown}"))))
    return checks


def _date_checks(contract: dict, column: dict, cell: Cell, row: Column, subject: Column) -> list[Check]:
    name, style = column["name"], column.get("format", "YYYY-MM-DD")
    if style != "YYYY-MM-DD":
        return [(F.lit(True), finding(
            subject, _rule(contract, "SETUP", name), "FAIL",
            F.lit(f"Unsupported date format in contract for {name}: {style}"),
            F.lit("supported format metadata"), F.lit(style)))]
    return [(cell.parsed.isNull(), finding(
        subject, _rule(contract, "TYPE", name), "FAIL",
        _say(f"{name} is not in {style} format in row ", row, ": '", cell.text, "'"),
        F.lit(f"format: {style}"), _say("row ", row, " value: ", cell.text)))]


def _text_checks(contract: dict, column: dict, cell: Cell, row: Column, subject: Column) -> list[Check]:
    name, allowed = column["name"], [str(a) for a in column.get("allowedValues") or []]
    if not allowed:
        return []
    shown = json.dumps(column["allowedValues"], separators=(",", ":"), ensure_ascii=False)
    return [(~cell.text.isin(allowed), finding(
        subject, _rule(contract, "ALLOWED", name), "FAIL",
        _say(f"{name} is not one of the allowed values in row ", row, ": '", cell.text, "'"),
        F.lit(f"allowed values: {shown}"), _say("row ", row, " value: ", cell.text)))]


_CELL_CHECKS = {"INTEGER": _integer_checks, "DATE": _date_checks, "STRING": _text_checks}


def row_findings(lines: DataFrame, contract: dict = INBOUND_CONTRACT) -> DataFrame:
    """Findings on data rows; `lines` has file, row_no, value and layout (from header_layout)."""
    ident, subject, row = contract["contractId"], F.col("file"), F.col("row_no")
    # A blank line has no cells, and no check fires on it. It is not filtered out, since Catalyst
    # would then compute `value` once more below.
    blank_line = is_blank(control_trim(F.col("value")))
    cells = F.when(~blank_line, F.split("value", re.escape(_delimiter(contract))))
    data = lines.where((row > 1) & F.col("layout").isNotNull()).select(
        "file", "row_no", "layout", cells.alias("cells")
    )
    columns = contract["columns"]
    # A cell beyond a short row is null, and then no check applies.
    cut = data.select(
        "file", "row_no", F.col("layout.width").alias("wanted"), F.size("cells").alias("width"),
        *[control_trim(F.get("cells", F.col("layout.places")[at])).alias(f"c{at}") for at in range(len(columns))],
    )
    typed = cut.select(
        "*",
        *[is_blank(F.col(f"c{at}")).alias(f"blank{at}") for at in range(len(columns))],
        *[_parsed(column, F.col(f"c{at}")).alias(f"p{at}") for at, column in enumerate(columns)],
    )
    found = [F.when(F.col("width") < F.col("wanted"), finding(
        subject, F.lit(f"{ident}-ROW-SHORT"), "FAIL", _say("Row ", row, " has fewer columns than header"),
        _say("column count: ", F.col("wanted")), _say("row ", row, " column count: ", F.col("width"))))]
    for at, column in enumerate(columns):
        cell = Cell(F.col(f"c{at}"), F.col(f"blank{at}"), F.col(f"p{at}"))
        if not column.get("nullable", False):
            found.append(F.when(cell.blank, finding(
                subject, _rule(contract, "NULL", column["name"]), "FAIL",
                _say(f"{column['name']} must not be blank in row ", row),
                F.lit("non-blank value"), _say("row ", row, ": blank"))))
        checks = _CELL_CHECKS.get(str(column.get("type", "")).upper())
        if checks:
            found += [F.when(~cell.blank & broken, entry)
                      for broken, entry in checks(contract, column, cell, row, subject)]
    return explode_findings(typed, found, "row_no")


def lines_of_content(contents: DataFrame, contract: dict = INBOUND_CONTRACT) -> DataFrame:
    """Numbered lines of files held as one text per row (file, content)."""
    cut = contents.select("file", F.split("content", r"\r?\n").alias("parts"))
    return cut.withColumn("layout", header_layout(F.col("parts")[0], contract)).select(
        "file", "layout", F.posexplode("parts").alias("at", "value")
    ).select("file", (F.col("at") + 1).cast("bigint").alias("row_no"), "value", "layout")


def heads_of_content(contents: DataFrame) -> DataFrame:
    return contents.select(
        "file",
        F.split("content", r"\r?\n")[0].alias("header"),
        (F.col("content").isNotNull() & ~is_blank(F.col("content"))).alias("has_text"),
    )


def heads_of_lines(lines: DataFrame) -> DataFrame:
    """Header per file of lines that are already numbered (file, row_no, value)."""
    opening = lines.where(F.col("row_no") == 1).select("file", F.col("value").alias("header"))
    filled = lines.groupBy("file").agg(F.max(~is_blank(F.col("value"))).alias("has_text"))
    return filled.join(opening, "file", "left")


def with_row_no(findings: DataFrame) -> DataFrame:
    return findings if "row_no" in findings.columns else findings.withColumn("row_no", F.lit(None).cast("bigint"))


def _all_findings(heads: DataFrame, lines: DataFrame, contract: dict) -> DataFrame:
    return with_row_no(header_findings(heads, contract)).unionByName(row_findings(lines, contract))


def check_contents(contents: DataFrame, contract: dict = INBOUND_CONTRACT) -> DataFrame:
    """Findings for files held as one text per row (file, content)."""
    return _all_findings(heads_of_content(contents), lines_of_content(contents, contract), contract)


def check_lines(lines: DataFrame, contract: dict = INBOUND_CONTRACT) -> DataFrame:
    """Findings for files held as numbered lines (file, row_no, value)."""
    # One row per file, used for the header checks and for reading the rows.
    heads = cut_lineage(heads_of_lines(lines))
    layouts = heads.select("file", header_layout(F.col("header"), contract).alias("layout"))
    return _all_findings(heads, lookup_join(lines, layouts, "file"), contract)


def check_blocks(source: LineBlocks, files: DataFrame, contract: dict = INBOUND_CONTRACT) -> DataFrame:
    """Findings for files scanned as lines; `files` lists them all, since an empty one has no line."""
    opening = source.blocks.where(F.col("block") == 0).select(
        "file", "header", "has_text"
    )
    heads = files.select("file").join(opening, "file", "left")
    laid_out = source._replace(
        blocks=source.blocks.withColumn("layout", header_layout(F.col("header"), contract))
    )
    return _all_findings(heads, number_lines(laid_out, "layout"), contract)


def check_files(spark: SparkSession, paths: str | Sequence[str], contract: dict = INBOUND_CONTRACT) -> DataFrame:
    """Findings for files on storage: subject (path), rule, severity, texts and physical row number."""
    return check_blocks(read_line_blocks(spark, paths), list_files(spark, paths), contract)


def file_status(files: DataFrame, findings: DataFrame) -> DataFrame:
    """Worst severity and number of findings per listed file; a file without findings passes."""
    per_file = findings.groupBy(F.col("subject").alias("file")).agg(
        worst(F.col("severity"), CONTRACT_SEVERITIES).alias("status"),
        F.count("*").alias("violations"),
    )
    return files.select("file").join(per_file, "file", "left").select(
        "file", F.coalesce("status", F.lit("PASS")).alias("status"),
        F.coalesce("violations", F.lit(0)).alias("violations"),
    )


def union_findings(frames: Sequence[DataFrame]) -> DataFrame:
    """Findings of many checks in one frame."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
