"""Recorded responses against the contract of their scenario."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.scalars import explode_findings, finding, is_blank, is_json_document, media_type, worst
from tillstone.model import CONTRACT_SEVERITIES, RESPONSE_SCENARIOS
from tillstone.operators.lookups import lookup_join


def standard_scenarios(spark: SparkSession) -> DataFrame:
    """The built-in response contracts as a scenario table."""
    def entry(contract: str, scenario: str, status: int, test: str, text: str, media: str) -> Column:
        def body(kind: str) -> Column:
            return F.lit(text if test == kind else None).cast("string").alias(f"body_{kind}")

        return F.struct(
            F.lit(contract).alias("contract_id"), F.lit(scenario).alias("scenario"),
            F.lit(status).alias("expected_status"), F.lit(media).alias("expected_type"),
            body("exact"), body("contains"), body("starts"),
        )

    table = F.array(*[entry(*row) for row in RESPONSE_SCENARIOS])
    return spark.range(1).select(F.explode(table).alias("s")).select("s.*")


def _quoted(label: str, text: Column) -> Column:
    return F.concat(F.lit(f'{label}: "'), text, F.lit('"'))


def check_responses(responses: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Findings per response; a scenario the contract does not know is a finding by itself.

    `responses` has response_id, contract_id, scenario, status, content_type and body.
    """
    known = scenarios.withColumn("_known", F.lit(True))
    joined = lookup_join(responses, known, ["contract_id", "scenario"], measure=True)
    matched = F.col("_known").isNotNull()
    body = F.coalesce("body", F.lit(""))
    want_type, got_type = media_type(F.col("expected_type")), media_type(F.col("content_type"))

    def entry(condition: Column, kind: str, text: Column, expected: Column, actual: Column) -> Column:
        rule = F.concat("contract_id", F.lit(f"-{kind}"))
        return F.when(condition, finding(F.col("response_id"), rule, "FAIL", text, expected, actual))

    def about(text: str) -> Column:
        return F.concat(F.lit(f"{text} for scenario '"), "scenario", F.lit("'"))

    found = [
        entry(~matched, "SCENARIO-NOT-FOUND",
              F.concat(F.lit("Scenario '"), "scenario", F.lit("' not found in contract "), "contract_id"),
              F.lit("scenario present"), F.lit("scenario absent")),
        entry(matched & ~F.col("status").eqNullSafe(F.col("expected_status")), "STATUS",
              about("HTTP status mismatch"),
              F.concat(F.lit("status: "), F.col("expected_status").cast("string")),
              F.concat(F.lit("status: "), F.coalesce(F.col("status").cast("string"), F.lit("none")))),
        entry(matched & ~is_blank(F.col("expected_type")) & (want_type != got_type), "CONTENT-TYPE",
              about("Content-Type mismatch"),
              F.concat(F.lit("content-type: "), want_type), F.concat(F.lit("content-type: "), got_type)),
        entry(matched & (body != F.col("body_exact")), "BODY-EXACT",
              about("Response body does not match expected exact value"),
              _quoted("body", F.col("body_exact")), _quoted("body", body)),
        entry(matched & ~body.contains(F.col("body_contains")), "BODY-CONTAINS",
              about("Response body does not contain expected substring"),
              _quoted("body contains", F.col("body_contains")), _quoted("body", body)),
        entry(matched & ~body.startswith(F.col("body_starts")), "BODY-PREFIX",
              about("Response body does not start with expected prefix"),
              _quoted("body starts with", F.col("body_starts")), _quoted("body", body)),
        entry(matched & ~want_type.contains("json") & is_json_document(body), "PLAINTEXT",
              about("Response body is valid JSON but contract requires plain text"),
              F.lit("content-type: text/plain, non-JSON body"),
              F.concat(F.lit("body parses as JSON: "), body)),
    ]
    return explode_findings(joined, found, "contract_id", "scenario")


def response_status(responses: DataFrame, findings: DataFrame) -> DataFrame:
    """Worst severity per contract and scenario seen in the log; clean ones pass."""
    keys = ["contract_id", "scenario"]
    seen = responses.groupBy(*keys).agg(F.count("*").alias("responses"))
    bad = findings.groupBy(*keys).agg(
        worst(F.col("severity"), CONTRACT_SEVERITIES).alias("status"), F.count("*").alias("violations")
    )
    return seen.join(bad, keys, "left").select(
        *keys, "responses", F.coalesce("violations", F.lit(0)).alias("violations"),
        F.coalesce("status", F.lit("PASS")).alias("status"),
    )
