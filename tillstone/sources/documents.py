"""Small documents: contracts, baselines, approvals, replay expectations."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.model import APPROVALS, BASELINE, EXPECTATION, RESPONSE_CONTRACT

_BROKEN = "_broken"


def _read_json(spark: SparkSession, paths, schema, lines: bool = False) -> DataFrame:
    """Read one JSON document per file, or one per line; a missing file or a broken document is an error."""
    frame = (
        spark.read.schema(schema)
        .option("multiLine", not lines)
        .option("mode", "FAILFAST")
        .json(paths if isinstance(paths, str) else list(paths))
    )
    return frame


def read_file_contract(spark: SparkSession, path: str) -> dict:
    """A file contract as a plain dictionary; it names a handful of columns."""
    rows = spark.read.text(path, wholetext=True).take(1)
    if not rows or not rows[0].value.strip():
        raise ValueError(f"empty contract document: {path}")
    contract = json.loads(rows[0].value)
    if not contract.get("columns"):
        raise ValueError(f"contract without columns: {path}")
    return contract


def read_response_contracts(spark: SparkSession, paths) -> DataFrame:
    return scenarios_of(_read_json(spark, paths, RESPONSE_CONTRACT))


def scenarios_of(contracts: DataFrame) -> DataFrame:
    """One row per contract scenario; the first entry of a name counts."""
    entries = contracts.select("contractId", F.posexplode("responses").alias("ord", "r"))
    first = entries.groupBy(
        F.col("contractId").alias("contract_id"), F.col("r.scenario").alias("scenario")
    ).agg(F.min_by("r", "ord").alias("r"))
    return first.select(
        "contract_id",
        "scenario",
        F.coalesce(F.col("r.expectedStatus"), F.lit(-1)).alias("expected_status"),
        F.coalesce(F.col("r.contentType"), F.lit("")).alias("expected_type"),
        F.col("r.expectedBodyExact").alias("body_exact"),
        F.col("r.expectedBodyContains").alias("body_contains"),
        F.col("r.expectedBodyStartsWith").alias("body_starts"),
    )


def read_baselines(spark: SparkSession, paths, lines: bool = False) -> DataFrame:
    """Baseline documents; with `lines`, one per line, so that large folders are split over tasks.

    A dataset may come in several documents with numbered parts, see `baseline.baseline_documents`.
    """
    return _read_json(spark, paths, BASELINE, lines)


def read_approvals(spark: SparkSession, path: str) -> DataFrame:
    """Approval entries from a JSON-lines folder or file; nothing there means no approvals."""
    try:
        frame = spark.read.schema(APPROVALS).json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        frame = spark.createDataFrame([], APPROVALS)
    return with_approval_defaults(frame)


def with_approval_defaults(frame: DataFrame) -> DataFrame:
    return frame.withColumns(
        {
            "expectedValue": F.coalesce("expectedValue", F.lit("")),
            "actualValue": F.coalesce("actualValue", F.lit("")),
            "matchType": F.coalesce("matchType", F.lit("exact")),
        }
    )


# The expectation fields that must be present.
REQUIRED_EXPECTATION_FIELDS = [
    "scenarioId", "description", "purpose", "fixtureFile", "runsSubmitted", "expectedStagedCount",
    "expectedPostedCount", "expectedRejectedCount", "expectedErrorCount", "expectedTotalPostedCents",
    "whatWouldBreakThis",
]


def read_expectations(spark: SparkSession, paths) -> DataFrame:
    return require_expectation_fields(_read_json(spark, paths, EXPECTATION))


def require_expectation_fields(frame: DataFrame) -> DataFrame:
    """Refuse an expectation that lacks a required field, a run count or any reconciliation part."""
    text_fields = {f.name for f in frame.schema.fields if f.dataType.typeName() == "string"}
    absent = []
    for field in REQUIRED_EXPECTATION_FIELDS:
        gap = F.col(field).isNull()
        if field in text_fields:
            gap = gap | (F.trim(field) == "")
        absent.append(F.when(gap, F.lit(field)))
    problem = F.concat_ws(
        ", ",
        *absent,
        F.when(F.col("runsSubmitted") < 1, "runsSubmitted must be > 0"),
        F.when(
            F.coalesce(
                F.to_json("expectedPerRun"), F.to_json("expectedReconciliation"), F.to_json("expectedAfterBothRuns")
            ).isNull(),
            "reconciliation expectations",
        ),
    )
    name = F.coalesce(F.col("scenarioId"), F.lit("?"))
    checked = F.when(problem == "", name).otherwise(
        F.raise_error(F.concat(F.lit("replay expectation "), name, F.lit(" lacks: "), problem))
    )
    return frame.withColumn("scenarioId", checked)
