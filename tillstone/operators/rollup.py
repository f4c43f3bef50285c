"""Findings, checks and replay results rolled up to one status per contract and per suite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.scalars import severity_label, severity_rank, text_list, worst
from tillstone.model import CONTRACT_SEVERITIES

KEYS = ["contract_id", "check_id"]


def outcome_text(status: Column, rules: Column) -> Column:
    """The recorded outcome of a check: its status and the rules that were hit."""
    return F.when(rules == "", F.concat(status, F.lit(" with no violations"))).otherwise(
        F.concat(status, F.lit(" with violations: "), rules)
    )


def check_outcomes(checks: DataFrame, findings: DataFrame) -> DataFrame:
    """What every check saw: worst severity, number of findings and the distinct rules.

    `checks` lists contract_id and check_id; `findings` carries both keys too.
    """
    hits = findings.groupBy(*KEYS).agg(
        F.max(severity_rank(F.col("severity"), CONTRACT_SEVERITIES)).alias("rank"),
        F.count("*").alias("violations"),
        text_list(F.col("rule_id")).alias("rules"),
    )
    status = severity_label(F.coalesce("rank", F.lit(0)), CONTRACT_SEVERITIES)
    rules = F.coalesce("rules", F.lit(""))
    return checks.join(hits, KEYS, "left").select(
        *checks.columns,
        status.alias("observed_status"),
        F.coalesce("violations", F.lit(0)).alias("violations"),
        rules.alias("rules"),
        outcome_text(status, rules).alias("actual_outcome"),
    )


def record_checks(outcomes: DataFrame) -> DataFrame:
    """Judge each check against its expected status and rule; passes are recorded too.

    A check that sees what it was made to see passes, whatever the status it saw; one that does
    not takes the status it saw.
    """
    rule = F.coalesce("expected_rule", F.lit(""))
    hit = (rule == "") | F.array_contains(F.split("rules", ", "), rule)
    passed = (F.col("observed_status") == F.col("expected_status")) & hit
    return outcomes.withColumns(
        {"passed": passed, "status": F.when(passed, "PASS").otherwise(F.col("observed_status"))}
    )


def contract_status(recorded: DataFrame) -> DataFrame:
    """Worst check status per contract."""
    return recorded.groupBy("contract_id").agg(
        worst(F.col("status"), CONTRACT_SEVERITIES).alias("status"),
        F.count("*").alias("checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )


def suite_status(contracts: DataFrame, replays: DataFrame) -> DataFrame:
    """One row: worst status over all contracts and replay scenarios, with their numbers."""
    parts = contracts.select("status", F.lit(1).alias("contract")).unionByName(
        replays.select("status", F.lit(0).alias("contract"))
    )
    return parts.agg(
        worst(F.col("status"), CONTRACT_SEVERITIES).alias("overall_status"),
        F.count_if(F.col("contract") == 1).alias("contract_results"),
        F.count_if(F.col("contract") == 0).alias("replay_results"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
    )
