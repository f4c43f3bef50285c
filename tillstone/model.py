"""Schemas, severity ranks and the fixed texts that results must carry."""

from __future__ import annotations

# Schemas are DDL texts, so they can be named before a session exists.
CUSTOMERS = (
    "customer_id INT NOT NULL, full_name STRING, email STRING NOT NULL, phone STRING, created_at TIMESTAMP"
)
ACCOUNTS = (
    "account_id INT NOT NULL, customer_id INT NOT NULL, account_type STRING, status STRING, "
    "opened_at DATE, credit_limit_cents INT"
)
MERCHANTS = "merchant_id INT NOT NULL, name STRING, category STRING, created_at TIMESTAMP"
INBOUND = (
    "account_id INT, merchant_id INT, direction STRING, amount_cents INT, txn_date STRING"
)
STAGED = (
    "id STRING, batch_id STRING, account_id INT, merchant_id INT, direction STRING, "
    "amount_cents INT, txn_date DATE, status STRING"
)
LEDGER = (
    "txn_id STRING, account_id INT, merchant_id INT, direction STRING, amount_cents INT, "
    "status STRING, description STRING, batch_id STRING"
)
BATCH_JOBS = (
    "id BIGINT, job_name STRING, status STRING, started_at TIMESTAMP, finished_at TIMESTAMP, record_count BIGINT"
)
BATCHES = "id STRING, batch_job_id BIGINT, file_name STRING, record_count BIGINT, status STRING"
ERRORS = "batch_job_id BIGINT, batch_id STRING, error_message STRING, record_ref STRING"
RECONCILIATIONS = (
    "batch_id STRING, staged_count BIGINT, posted_count BIGINT, staged_total_cents BIGINT, "
    "posted_total_cents BIGINT, counts_match BOOLEAN, totals_match BOOLEAN"
)
STAGE_RUNS = (
    "run_id BIGINT, job_name STRING, status STRING, started_at TIMESTAMP, finished_at TIMESTAMP, record_count BIGINT"
)
BASELINE = (
    "datasetId STRING, description STRING, stagedCount INT, postedCount INT, rejectedCount INT, "
    "errorCount INT, totalPostedCents BIGINT, part INT, "
    "reconciliation STRUCT<countsMatch: BOOLEAN, totalsMatch: BOOLEAN>, "
    "transactions ARRAY<STRUCT<accountId: INT, merchantId: INT, direction: STRING, amountCents: BIGINT, "
    "description: STRING>>, "
    "errors ARRAY<STRUCT<errorMessage: STRING, recordRef: STRING>>"
)
APPROVALS = (
    "dataset_id STRING, entry_ord INT, id STRING, field STRING, scope STRING, expectedValue STRING, "
    "actualValue STRING, matchType STRING, classification STRING, rationale STRING, "
    "reviewCriteria ARRAY<STRING>, approvedBy STRING, approvedDate STRING, ticket STRING"
)
RECON_EXPECTATION = (
    "STRUCT<rowCount: INT, stagedCount: INT, postedCount: INT, stagedTotalCents: BIGINT, "
    "postedTotalCents: BIGINT, countsMatch: BOOLEAN, totalsMatch: BOOLEAN>"
)
AGGREGATE_EXPECTATION = (
    "STRUCT<totalStagedTransactions: INT, totalPostedTransactions: INT, reconciliationRowCount: INT, "
    "eachRowCountsMatch: BOOLEAN, eachRowTotalsMatch: BOOLEAN>"
)
EXPECTATION = (
    "scenarioId STRING, description STRING, purpose STRING, fixtureFile STRING, runsSubmitted INT, "
    "expectedStagedCount INT, expectedPostedCount INT, expectedRejectedCount INT, expectedErrorCount INT, "
    f"expectedTotalPostedCents BIGINT, expectedPerRun {RECON_EXPECTATION}, "
    f"expectedReconciliation {RECON_EXPECTATION}, expectedAfterBothRuns {AGGREGATE_EXPECTATION}, "
    "whatWouldBreakThis STRING"
)
RESPONSE_LOG = (
    "response_id STRING, contract_id STRING, scenario STRING, status INT, content_type STRING, body STRING"
)
RESPONSE_CONTRACT = (
    "contractId STRING, endpoint STRING, responses ARRAY<STRUCT<scenario: STRING, expectedStatus: INT, "
    "expectedBodyExact: STRING, expectedBodyContains: STRING, expectedBodyStartsWith: STRING, "
    "contentType: STRING>>"
)
# Every audit emits this shape; `subject` is the file, response, batch scope or table looked at.
FINDINGS = (
    "subject STRING, rule_id STRING, severity STRING, description STRING, expected STRING, actual STRING"
)

# Severities, mildest first.
CONTRACT_SEVERITIES = ["PASS", "WARNING", "FAIL"]
VERIFICATION_SEVERITIES = ["PASS", "APPROVED_DIFFERENCE", "WARNING", "FAIL"]

# Row states, ledger texts and job names.
STAGED_STATE, VALIDATED_STATE, REJECTED_STATE, POSTED_STATE = "staged", "validated", "rejected", "posted"
LEDGER_DESCRIPTION = "Batch posted"
LOAD_JOB = "load_transactions"
VALIDATE_JOB = "validate_transactions"
POST_JOB = "post_transactions"
RECONCILE_JOB = "reconcile_batches"
REJECT_LIMIT = 10_000

# Rejection messages.
AMOUNT_MESSAGE = "amount must be positive; "
DIRECTION_MESSAGE = "direction must be D or C; "
ACCOUNT_MISSING_MESSAGE = "account not found; "
ACCOUNT_INACTIVE_MESSAGE = "account is not active; "

# The inbound-file contract.
INBOUND_CONTRACT = {
    "contractId": "ACH-FILE-001",
    "delimiter": ",",
    "columns": [
        {"name": "account_id", "position": 0, "type": "INTEGER", "nullable": False},
        {"name": "merchant_id", "position": 1, "type": "INTEGER", "nullable": True},
        {"name": "direction", "position": 2, "type": "STRING", "nullable": False, "allowedValues": ["D", "C"]},
        {"name": "amount_cents", "position": 3, "type": "INTEGER", "nullable": False,
         "constraints": {"minimum": 1}},
        {"name": "txn_date", "position": 4, "type": "DATE", "nullable": False, "format": "YYYY-MM-DD"},
    ],
}
RULE_SUFFIX = {
    "account_id": "ACCOUNT",
    "merchant_id": "MERCHANT",
    "direction": "DIR",
    "amount_cents": "AMOUNT",
    "txn_date": "DATE",
}

# The response contracts (contract, scenario, status, body test, body text, media type).
RESPONSE_SCENARIOS = [
    ("API-BATCH-RUN-001", "clean_trigger", 200, "exact", "Pipeline completed successfully", "text/plain"),
    ("API-BATCH-RUN-001", "concurrent_trigger", 409, "contains", "already running", "text/plain"),
    ("API-BATCH-RUN-001", "pipeline_failure", 500, "starts", "Pipeline failed:", "text/plain"),
    ("API-BATCH-STATUS-001", "pipeline_idle", 200, "exact", "idle", "text/plain"),
    ("API-BATCH-STATUS-001", "pipeline_running", 200, "exact", "running", "text/plain"),
]

# The output invariants.
INVARIANTS = {
    "INV-001": "counts_match must be true after a clean run with no rejected records",
    "INV-002": "totals_match must be true after a clean run with no rejected records",
    "INV-003": "Rejected records must be excluded from staged_count and staged_total_cents",
    "INV-004": "Each batch_id must have exactly one reconciliation row — no duplicates on retry",
    "INV-005": "staged_count and posted_count must both be >= 0",
    "INV-006": "posted_count must never exceed staged_count — cannot post more than were staged as posted",
}
