"""Row rules, the reject log and the reject limit."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.scalars import pad_trim
from tillstone.model import (
    ACCOUNT_INACTIVE_MESSAGE,
    ACCOUNT_MISSING_MESSAGE,
    AMOUNT_MESSAGE,
    DIRECTION_MESSAGE,
    REJECT_LIMIT,
    REJECTED_STATE,
    STAGED_STATE,
    VALIDATED_STATE,
)
from tillstone.operators.lookups import lookup_join


class Rule(NamedTuple):
    """A row is rejected with `message` when `broken` holds; null counts as not broken."""

    rule_id: str
    broken: Column
    message: str


def standard_rules(fold_direction: bool = False) -> list[Rule]:
    """The four intake rules, in message order. `fold_direction` accepts lower-case codes."""
    code = pad_trim(F.col("direction"))
    if fold_direction:
        code = F.upper(code)
    found = F.col("account_status")
    return [
        Rule("amount", F.col("amount_cents").isNull() | (F.col("amount_cents") <= 0), AMOUNT_MESSAGE),
        Rule("direction", ~code.isin("D", "C"), DIRECTION_MESSAGE),
        Rule("account_exists", found.isNull(), ACCOUNT_MISSING_MESSAGE),
        Rule("account_active", found != "active", ACCOUNT_INACTIVE_MESSAGE),
    ]


def validate(staged: DataFrame, accounts: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Give every row a status and, when rejected, all its messages in rule order."""
    states = accounts.select("account_id", F.col("status").alias("account_status"))
    joined = lookup_join(staged, states, "account_id")
    texts = [F.when(r.broken, r.message).otherwise("") for r in (rules or standard_rules())]
    judged = joined.withColumn("error_message", F.concat(*texts))
    passed = F.col("error_message") == ""
    return judged.select(
        *[c for c in staged.columns if c != "status"],
        F.when(passed, VALIDATED_STATE).otherwise(REJECTED_STATE).alias("status"),
        F.when(~passed, F.col("error_message")).alias("error_message"),
    )


def accepted(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("status") == VALIDATED_STATE).drop("error_message")


def reject_log(outcomes: DataFrame, job_id: Column | int | None = None) -> DataFrame:
    """One error row per rejected row, holding its whole message; `job_id` is the validating job."""
    job = job_id if isinstance(job_id, Column) else F.lit(job_id)
    extra = [c for c in ("dataset_id", "scenario_id", "run_id") if c in outcomes.columns]
    return outcomes.where(F.col("status") == REJECTED_STATE).select(
        job.cast("bigint").alias("batch_job_id"),
        "batch_id",
        "error_message",
        F.concat(F.lit("staged_transactions.id="), F.col("id").cast("string")).alias("record_ref"),
        *extra,
    )


def reject_counts(outcomes: DataFrame, limit: int = REJECT_LIMIT) -> DataFrame:
    """Rejects per batch and whether they stay within the limit."""
    return (
        outcomes.groupBy("batch_id")
        .agg(
            F.count("*").alias("read_count"),
            F.count_if(F.col("status") == VALIDATED_STATE).alias("write_count"),
            F.count_if(F.col("status") == REJECTED_STATE).alias("skip_count"),
        )
        .withColumn("within_limit", F.col("skip_count") <= limit)
        .withColumn("batch_status", F.when(F.col("within_limit"), "completed").otherwise("failed"))
    )


def hold_failed_batches(outcomes: DataFrame, limit: int = REJECT_LIMIT) -> DataFrame:
    """Leave every row of a batch over the reject limit staged."""
    failed = reject_counts(outcomes, limit).where(~F.col("within_limit")).select(
        "batch_id", F.lit(True).alias("_failed")
    )
    flagged = lookup_join(outcomes, failed, "batch_id", measure=True)
    return flagged.select(
        *[c for c in outcomes.columns if c not in ("status", "error_message")],
        F.when(F.col("_failed"), STAGED_STATE).otherwise(F.col("status")).alias("status"),
        F.when(F.col("_failed").isNull(), F.col("error_message")).alias("error_message"),
    )
