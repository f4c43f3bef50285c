"""Table constraints as audits: keys, not-null, checks and references."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.operators.lookups import orphan_counts


class TableRules(NamedTuple):
    """Constraints of one table; checks are (name, SQL predicate), references (column, parent, key)."""

    key: Sequence[str] = ()
    required: Sequence[str] = ()
    checks: Sequence[tuple[str, str]] = ()
    references: Sequence[tuple[str, str, str]] = ()


# The constraints of the bank tables.
BANK_RULES = {
    "customers": TableRules(
        key=["customer_id"], required=["customer_id", "full_name", "email", "created_at"],
    ),
    "accounts": TableRules(
        key=["account_id"],
        required=["account_id", "customer_id", "account_type", "status", "opened_at", "credit_limit_cents"],
        checks=[
            ("accounts_account_type_check", "account_type IN ('checking', 'savings', 'credit')"),
            ("accounts_status_check", "status IN ('active', 'frozen', 'closed')"),
            ("accounts_credit_limit_cents_check", "credit_limit_cents >= 0"),
        ],
        references=[("customer_id", "customers", "customer_id")],
    ),
    "merchants": TableRules(key=["merchant_id"], required=["merchant_id", "name", "category", "created_at"]),
    "transactions": TableRules(
        key=["txn_id"],
        required=["txn_id", "account_id", "direction", "amount_cents", "status"],
        checks=[
            ("transactions_amount_cents_check", "amount_cents > 0"),
            ("transactions_direction_check", "direction IN ('D', 'C')"),
            ("transactions_status_check", "status IN ('posted', 'pending', 'reversed')"),
        ],
        references=[
            ("account_id", "accounts", "account_id"),
            ("merchant_id", "merchants", "merchant_id"),
            ("batch_id", "transaction_batches", "id"),
        ],
    ),
    "batch_jobs": TableRules(key=["id"], required=["id", "job_name", "status", "started_at"]),
    "transaction_batches": TableRules(
        key=["id"], required=["id", "batch_job_id", "file_name", "status"],
        references=[("batch_job_id", "batch_jobs", "id")],
    ),
    "batch_job_errors": TableRules(
        required=["batch_job_id", "error_message"], references=[("batch_job_id", "batch_jobs", "id")],
    ),
    "staged_transactions": TableRules(
        key=["id"],
        required=["id", "batch_id", "account_id", "direction", "amount_cents", "txn_date", "status"],
        references=[("batch_id", "transaction_batches", "id"), ("merchant_id", "merchants", "merchant_id")],
    ),
    "batch_reconciliations": TableRules(
        required=[
            "batch_id", "staged_count", "posted_count", "staged_total_cents", "posted_total_cents",
            "counts_match", "totals_match",
        ],
        references=[("batch_id", "transaction_batches", "id")],
    ),
}


def _line(frame: DataFrame, table: str, kind: str, name: str, value) -> DataFrame:
    return frame.select(
        F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), F.lit(name).alias("constraint_name"),
        value.cast("bigint").alias("offenders"),
    )


def row_audit(table: str, frame: DataFrame, rules: TableRules) -> DataFrame:
    """Not-null and check offenders of a table, counted in one pass; a null check counts as met."""
    tests = [("not_null", c, F.col(c).isNull()) for c in rules.required if c in frame.columns]
    tests += [("check", name, ~F.expr(predicate)) for name, predicate in rules.checks]
    counted = frame.agg(*[F.count_if(bad).alias(f"_{n}") for n, (_, _, bad) in enumerate(tests)])
    lines = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(kind).alias("kind"),
                 F.lit(name).alias("constraint_name"), F.col(f"_{n}").alias("offenders"))
        for n, (kind, name, _) in enumerate(tests)
    ])
    return counted.select(F.explode(lines).alias("l")).select("l.*")


def key_audit(table: str, frame: DataFrame, rules: TableRules) -> DataFrame:
    """How many key values occur more than once."""
    repeated = frame.groupBy(*rules.key).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return _line(repeated.agg(F.count("*").alias("n")), table, "primary_key", ",".join(rules.key), F.col("n"))


def reference_audit(table: str, frame: DataFrame, rules: TableRules, tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Rows whose reference names no parent row; null references are allowed."""
    lines = []
    for column, parent, key in rules.references:
        if parent not in tables or column not in frame.columns:
            continue
        orphans = orphan_counts(frame, column, tables[parent], key)
        total = orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
        lines.append(_line(total, table, "foreign_key", f"{column}->{parent}.{key}", F.col("n")))
    return lines


def audit(
    tables: dict[str, DataFrame],
    rules: dict[str, TableRules] | None = None,
    kinds: Sequence[str] = ("primary_key", "not_null", "check", "foreign_key"),
) -> DataFrame:
    """One line per constraint with the number of offenders, for every given table."""
    rules = rules or BANK_RULES
    lines: list[DataFrame] = []
    for name, frame in tables.items():
        rule = rules.get(name)
        if rule is None:
            continue
        if {"not_null", "check"} & set(kinds) and (rule.required or rule.checks):
            wanted = rule._replace(
                required=rule.required if "not_null" in kinds else (),
                checks=rule.checks if "check" in kinds else (),
            )
            if wanted.required or wanted.checks:
                lines.append(row_audit(name, frame, wanted))
        if "primary_key" in kinds and rule.key:
            lines.append(key_audit(name, frame, rule))
        if "foreign_key" in kinds:
            lines += reference_audit(name, frame, rule, tables)
    return reduce(lambda a, b: a.unionByName(b), lines)


def broken(audited: DataFrame) -> DataFrame:
    return audited.where(F.col("offenders") > 0)
