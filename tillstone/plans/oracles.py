"""DuckDB statements that give the same rows as the registered queries."""

from __future__ import annotations

import re

from tillstone.plans.catalog import RUN_SINCE, TIGHT_LIMIT
from tillstone.plans.file_path import RUNS

# Whitespace characters that are cut from the ends of a text.
_WS = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}]"
_INNER = r"[ \t\n\x{0B}\f\r]+"


def squeeze(column: str) -> str:
    return (
        f"regexp_replace(regexp_replace({column}, '^{_WS}+|{_WS}+$', '', 'g'), '{_INNER}', ' ', 'g')"
    )


def message(direction: str) -> str:
    return f"""concat(
        CASE WHEN s.amount_cents <= 0 THEN 'amount must be positive; ' ELSE '' END,
        CASE WHEN {direction} NOT IN ('D', 'C') THEN 'direction must be D or C; ' ELSE '' END,
        CASE WHEN a.status IS NULL THEN 'account not found; ' ELSE '' END,
        CASE WHEN a.status <> 'active' THEN 'account is not active; ' ELSE '' END)"""


# The bank tables and findings as SQL; each entry may use the ones above it.
VIEWS: dict[str, str] = {
    "b_customers": """
  SELECT c_custkey + 1001 AS customer_id, c_name AS full_name,
         CASE WHEN c_nationkey <> 3 THEN lower(c_name) || '@example.com' END AS email,
         TIMESTAMP '2024-01-01' AS created_at
  FROM customer""",
    "b_accounts": """
  SELECT c_custkey + 2001 AS account_id, c_custkey + 1001 AS customer_id,
         CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'checking'
              WHEN c_mktsegment = 'AUTOMOBILE' THEN 'savings'
              WHEN c_mktsegment = 'MACHINERY' THEN 'credit' ELSE 'other' END AS account_type,
         CASE WHEN c_acctbal < -500 THEN 'closed' WHEN c_acctbal < 0 THEN 'frozen' ELSE 'active' END AS status,
         DATE '2024-01-01' AS opened_at, CAST(round(c_acctbal * 100) AS INTEGER) AS credit_limit_cents
  FROM customer WHERE c_nationkey <> 7""",
    "b_merchants": """
  SELECT s_suppkey + 3001 AS merchant_id, s_name AS name, n_name AS category, TIMESTAMP '2024-01-01' AS created_at
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_nationkey <> 15""",
    "b_staged": """
  SELECT o_orderkey AS id,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS batch_id,
         concat(year(o_orderdate) * 100 + month(o_orderdate), '/', o_orderpriority) AS dataset_id,
         o_custkey + 2001 AS account_id,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 10 + 3001 END AS merchant_id,
         CASE WHEN o_orderstatus = 'F' THEN 'D' WHEN o_orderstatus = 'O' THEN 'C'
              WHEN o_orderpriority = '1-URGENT' THEN 'd' WHEN o_orderpriority = '2-HIGH' THEN 'X'
              ELSE 'D' END AS direction,
         CAST(round(o_totalprice * 100) AS INTEGER) - 500000 AS amount_cents,
         CAST(o_orderdate AS DATE) AS txn_date
  FROM orders""",
    "b_judged": f"""
  SELECT s.*, {message("s.direction")} AS message
  FROM b_staged s LEFT JOIN b_accounts a USING (account_id)""",
    "b_outcomes": """
  SELECT * EXCLUDE (message), CASE WHEN message = '' THEN 'validated' ELSE 'rejected' END AS status,
         nullif(message, '') AS error_message
  FROM b_judged""",
    "b_table": """
  SELECT * REPLACE (CASE WHEN status = 'validated' THEN 'posted' ELSE status END AS status) FROM b_outcomes""",
    "b_errors": """
  SELECT batch_id * 10 + 1 AS batch_job_id, batch_id, error_message,
         concat('staged_transactions.id=', id) AS record_ref, dataset_id
  FROM b_outcomes WHERE status = 'rejected'""",
    "b_ledger": """
  SELECT id AS txn_id, account_id, merchant_id, direction, amount_cents, 'posted' AS status,
         'Batch posted' AS description, batch_id, dataset_id
  FROM b_outcomes WHERE status = 'validated'""",
    "b_faulty": """
  SELECT id AS txn_id, account_id, merchant_id, direction,
         CASE WHEN merchant_id = 3004 AND amount_cents > 45000000 THEN amount_cents + 1
              ELSE amount_cents END AS amount_cents,
         'posted' AS status, 'Batch posted' AS description, batch_id, dataset_id
  FROM b_outcomes,
       (VALUES (1), (2)) AS c(copy)
  WHERE status = 'validated' AND NOT (month(txn_date) = 3 AND day(txn_date) = 15)
    AND (copy = 1 OR (month(txn_date) = 7 AND day(txn_date) = 4))""",
    "b_batches": """
  SELECT batch_id AS id, batch_id * 10 AS batch_job_id, concat('ach_', batch_id, '.csv') AS file_name,
         count(*) AS record_count, 'received' AS status
  FROM b_staged GROUP BY batch_id""",
    "b_jobs": """
  SELECT batch_id * 10 + off AS id, job_name,
         CASE WHEN off = 2 AND batch_id >= 200101 THEN 'running' ELSE 'completed' END AS status,
         CAST(first AS TIMESTAMP) AS started_at,
         CASE WHEN off = 2 AND batch_id >= 200101 THEN NULL ELSE CAST(last AS TIMESTAMP) END AS finished_at,
         n AS record_count
  FROM (SELECT batch_id, count(*) AS n, min(txn_date) AS first, max(txn_date) AS last FROM b_staged GROUP BY 1),
       (VALUES (0, 'load_transactions'), (1, 'validate_transactions'), (2, 'post_transactions')) j(off, job_name)""",
    "b_sides": """
  SELECT st.batch_id, st.n AS staged_count, coalesce(l.n, 0) AS posted_count, st.total AS staged_total_cents,
         coalesce(l.total, 0) AS posted_total_cents
  FROM (SELECT batch_id, count(*) AS n, CAST(sum(amount_cents) AS BIGINT) AS total
        FROM b_table WHERE status = 'posted' GROUP BY 1) st
  LEFT JOIN (SELECT batch_id, count(*) AS n, CAST(sum(amount_cents) AS BIGINT) AS total
             FROM b_faulty GROUP BY 1) l USING (batch_id)""",
    "b_recon": """
  SELECT *, staged_count = posted_count AS counts_match, staged_total_cents = posted_total_cents AS totals_match
  FROM b_sides""",
    "b_tampered": """
  SELECT batch_id, staged_count + CASE WHEN batch_id % 100 = 9 THEN 1 ELSE 0 END AS staged_count,
         CASE WHEN batch_id % 100 = 12 THEN -1 ELSE posted_count END AS posted_count,
         staged_total_cents + CASE WHEN batch_id % 100 = 5 THEN 1 ELSE 0 END AS staged_total_cents,
         posted_total_cents, counts_match, totals_match
  FROM b_recon, (VALUES (1), (2)) c(copy) WHERE copy = 1 OR batch_id % 100 = 7""",
    "b_legacy": f"""
  SELECT s.* REPLACE (upper(s.direction) AS direction), {message("upper(s.direction)")} AS message
  FROM (SELECT * REPLACE (CASE WHEN ends_with(dataset_id, '3-MEDIUM')
                               THEN amount_cents - ((amount_cents % 10) + 10) % 10
                               ELSE amount_cents END AS amount_cents) FROM b_staged) s
  LEFT JOIN b_accounts a USING (account_id)""",
    "b_actual_metrics": """
  SELECT dataset_id, count(*) AS staged_count, count(*) FILTER (error_message IS NULL) AS posted_count,
         count(*) FILTER (error_message IS NOT NULL) AS rejected_count,
         count(*) FILTER (error_message IS NOT NULL) AS error_count,
         CAST(coalesce(sum(amount_cents) FILTER (error_message IS NULL), 0) AS BIGINT) AS total_posted_cents
  FROM b_outcomes GROUP BY 1""",
    "b_legacy_metrics": """
  SELECT dataset_id, count(*) AS staged_count, count(*) FILTER (message = '') AS posted_count,
         count(*) FILTER (message <> '') AS rejected_count, count(*) FILTER (message <> '') AS error_count,
         CAST(coalesce(sum(amount_cents) FILTER (message = ''), 0) AS BIGINT) AS total_posted_cents
  FROM b_legacy GROUP BY 1""",
    "b_legacy_rows": """
  SELECT dataset_id, account_id, merchant_id, direction, CAST(amount_cents AS BIGINT) AS amount_cents,
         'Batch posted' AS description, CAST(id AS VARCHAR) AS ref,
         row_number() OVER (PARTITION BY dataset_id ORDER BY account_id, amount_cents, direction) - 1 AS idx
  FROM b_legacy WHERE message = ''""",
    "b_actual_rows": """
  SELECT dataset_id, direction, amount_cents, 'Batch posted' AS description,
         row_number() OVER (PARTITION BY dataset_id ORDER BY account_id, amount_cents, direction) - 1 AS idx
  FROM b_ledger""",
    "b_legacy_texts": """
  SELECT dataset_id, text, row_number() OVER (PARTITION BY dataset_id ORDER BY text) - 1 AS idx
  FROM (SELECT dataset_id, CASE WHEN message = 'account is not active; ' THEN 'ERR_ACCT_INACTIVE'
                                ELSE trim(message) END AS text FROM b_legacy WHERE message <> '')""",
    "b_actual_texts": """
  SELECT dataset_id, trim(error_message) AS text,
         row_number() OVER (PARTITION BY dataset_id ORDER BY trim(error_message)) - 1 AS idx
  FROM b_errors""",
    "b_baseline_side": """
  SELECT * FROM b_legacy_metrics WHERE NOT ends_with(dataset_id, '11/5-LOW')""",
    "b_run_side": """
  SELECT * FROM b_actual_metrics WHERE NOT ends_with(dataset_id, '12/5-LOW')""",
    "b_compared": f"""
  SELECT dataset_id, f.field, CAST(f.e AS VARCHAR) AS expected, CAST(f.a AS VARCHAR) AS actual, f.e = f.a AS equal
  FROM (SELECT dataset_id, unnest([
          {{'field': 'stagedCount', 'e': coalesce(b.staged_count, 0), 'a': coalesce(a.staged_count, 0)}},
          {{'field': 'postedCount', 'e': coalesce(b.posted_count, 0), 'a': coalesce(a.posted_count, 0)}},
          {{'field': 'rejectedCount', 'e': coalesce(b.rejected_count, 0), 'a': coalesce(a.rejected_count, 0)}},
          {{'field': 'errorCount', 'e': coalesce(b.error_count, 0), 'a': coalesce(a.error_count, 0)}},
          {{'field': 'totalPostedCents', 'e': coalesce(b.total_posted_cents, 0),
            'a': coalesce(a.total_posted_cents, 0)}}]) AS f
        FROM b_baseline_side b FULL JOIN b_run_side a USING (dataset_id))
  UNION ALL
  SELECT dataset_id, concat('transactions[', idx, '].', f.field), f.e, f.a, f.e IS NOT DISTINCT FROM f.a
  FROM (SELECT b.dataset_id, b.idx, unnest([
          {{'field': 'direction', 'e': b.direction, 'a': a.direction}},
          {{'field': 'amountCents', 'e': CAST(b.amount_cents AS VARCHAR), 'a': CAST(a.amount_cents AS VARCHAR)}},
          {{'field': 'description', 'e': b.description, 'a': a.description}}]) AS f
        FROM b_legacy_rows b
        JOIN b_baseline_side bm USING (dataset_id) JOIN b_run_side am USING (dataset_id)
        LEFT JOIN b_actual_rows a ON a.dataset_id = b.dataset_id AND a.idx = b.idx
        WHERE bm.posted_count = am.posted_count)
  UNION ALL
  SELECT b.dataset_id, concat('errors[', b.idx, '].errorMessage'), b.text, a.text, b.text = a.text
  FROM b_legacy_texts b JOIN b_actual_texts a USING (dataset_id, idx)
  WHERE dataset_id IN (SELECT dataset_id FROM b_baseline_side) AND dataset_id IN (SELECT dataset_id FROM b_run_side)""",
    "b_approvals": """
  SELECT dataset_id, ord, field, ev, av,
         CASE WHEN signer = 'late' THEN CASE WHEN dataset_id >= '199801' THEN 'a.reviewer' ELSE ' ' END
              ELSE signer END AS signer
  FROM (SELECT DISTINCT dataset_id FROM b_staged),
       (VALUES (1, 'postedCount', '', '', 'late'),
               (2, 'errors[0].errorMessage', 'ERR_ACCT_INACTIVE', 'account is not active', 'b.reviewer'),
               (3, 'totalPostedCents', '0', '', ''),
               (4, 'totalPostedCents', '', '', 'b.reviewer')) e(ord, field, ev, av, signer)""",
    "b_classified": """
  SELECT c.dataset_id, c.field, c.expected, c.actual,
         CASE WHEN ap.ord IS NULL THEN 'FAIL' WHEN trim(ap.signer) <> '' THEN 'APPROVED_DIFFERENCE'
              ELSE 'WARNING' END AS classification,
         'entry ' || ap.ord AS rationale
  FROM b_compared c
  LEFT JOIN b_approvals ap ON ap.dataset_id = c.dataset_id AND ap.field = c.field
        AND (c.expected IS NULL OR contains(c.expected, ap.ev)) AND (c.actual IS NULL OR contains(c.actual, ap.av))
  WHERE NOT c.equal
  QUALIFY row_number() OVER (PARTITION BY c.dataset_id, c.field ORDER BY ap.ord NULLS LAST) = 1""",
    "b_results": """
  SELECT p.dataset_id,
         CASE WHEN coalesce(f.fail_count, 0) > 0 THEN 'FAIL' WHEN coalesce(f.warning_count, 0) > 0 THEN 'WARNING'
              WHEN coalesce(f.approved_count, 0) > 0 THEN 'APPROVED_DIFFERENCE' ELSE 'PASS' END AS overall_status,
         p.pass_count, coalesce(f.warning_count, 0) AS warning_count, coalesce(f.fail_count, 0) AS fail_count,
         coalesce(f.approved_count, 0) AS approved_count
  FROM (SELECT dataset_id, count(*) FILTER (equal) AS pass_count FROM b_compared GROUP BY 1) p
  LEFT JOIN (SELECT dataset_id, count(*) FILTER (classification = 'WARNING') AS warning_count,
                    count(*) FILTER (classification = 'FAIL') AS fail_count,
                    count(*) FILTER (classification = 'APPROVED_DIFFERENCE') AS approved_count
             FROM b_classified GROUP BY 1) f USING (dataset_id)""",
    "b_file_cells": """
  SELECT concat('ach_', batch_id, '.csv') AS file, batch_id % 100 AS month, id + 2 AS row_no, amount_cents, direction,
         CASE WHEN amount_cents > 49400000 THEN '' ELSE CAST(account_id AS VARCHAR) END AS account,
         CASE WHEN merchant_id = 3006 AND amount_cents < 1000000 THEN 'abc'
              ELSE coalesce(CAST(merchant_id AS VARCHAR), '') END AS merchant,
         CASE WHEN direction = 'C' AND amount_cents > 48000000 THEN amount_cents || '.0'
              ELSE CAST(amount_cents AS VARCHAR) END AS amount,
         CASE WHEN merchant_id = 3003 AND direction = 'D' THEN strftime(txn_date, '%m/%d/%Y')
              ELSE strftime(txn_date, '%Y-%m-%d') END AS day
  FROM b_staged""",
    "b_lines": """
  SELECT o.*, c.amount, CASE WHEN account = '' THEN 'account_id is not an integer'
                   WHEN merchant = 'abc' THEN 'merchant_id is not an integer'
                   WHEN ends_with(amount, '.0') THEN 'amount_cents is not an integer' END AS problem
  FROM b_outcomes o JOIN b_file_cells c ON c.row_no = o.id + 2""",
    "b_file_checked": """
SELECT * FROM b_file_cells WHERE month NOT IN (2, 8, 10)""",
    "b_files": """
SELECT DISTINCT batch_id % 100 AS month, concat('ach_', batch_id, '.csv') AS file FROM b_staged""",
    "b_file_findings": """
  SELECT file AS subject, 'ACH-FILE-001-COL-MISSING' AS rule_id, 'FAIL' AS severity,
         'Required column missing from header: ' || name AS description, 'column present: ' || name AS expected,
         'column absent' AS actual, CAST(NULL AS BIGINT) AS row_no
  FROM b_files JOIN (VALUES (2, 'txn_date'), (10, 'amount_cents')) m(month, name) USING (month)
  UNION ALL
  SELECT file, 'ACH-FILE-001-COL-EXTRA', 'WARNING',
         'Unexpected column in header: ''' || name || ''' — not in contract definition',
         'columns: [account_id, merchant_id, direction, amount_cents, txn_date]', 'extra column: ' || name, NULL
  FROM b_files JOIN (VALUES (4, 'notes'), (10, 'amount')) m(month, name) USING (month)
  UNION ALL
  SELECT file, 'ACH-FILE-001-COL-ORDER', 'WARNING',
         concat('Column ''', name, ''' is at position ', got, ' but contract requires position ', want),
         'position ' || want, 'position ' || got, NULL
  FROM b_files, (VALUES ('direction', 3, 2), ('amount_cents', 2, 3)) m(name, got, want) WHERE month = 6
  UNION ALL
  SELECT file, 'ACH-FILE-001-DELIM', 'FAIL',
         'File does not appear to use the contracted delimiter — header does not contain '',''',
         'delimiter: ,', 'delimiter missing from header', NULL
  FROM b_files WHERE month = 8
  UNION ALL
  SELECT file, 'ACH-FILE-001-ROW-SHORT', 'FAIL', concat('Row ', row_no, ' has fewer columns than header'),
         'column count: 6', concat('row ', row_no, ' column count: 5'), row_no
  FROM b_file_checked WHERE month = 4
  UNION ALL
  SELECT file, 'ACH-FILE-001-NULL-ACCOUNT', 'FAIL', concat('account_id must not be blank in row ', row_no),
         'non-blank value', concat('row ', row_no, ': blank'), row_no
  FROM b_file_checked WHERE account = ''
  UNION ALL
  SELECT file, 'ACH-FILE-001-TYPE-MERCHANT', 'FAIL',
         concat('merchant_id is not a valid integer in row ', row_no, ': ''', merchant, ''''),
         'type: INTEGER', concat('row ', row_no, ' value: ', merchant), row_no
  FROM b_file_checked WHERE merchant = 'abc'
  UNION ALL
  SELECT file, 'ACH-FILE-001-ALLOWED-DIR', 'FAIL',
         concat('direction is not one of the allowed values in row ', row_no, ': ''', direction, ''''),
         'allowed values: ["D","C"]', concat('row ', row_no, ' value: ', direction), row_no
  FROM b_file_checked WHERE direction NOT IN ('D', 'C')
  UNION ALL
  SELECT file, 'ACH-FILE-001-TYPE-AMOUNT', 'FAIL',
         concat('amount_cents is not a valid integer in row ', row_no, ': ''', amount, ''''),
         'type: INTEGER', concat('row ', row_no, ' value: ', amount), row_no
  FROM b_file_checked WHERE ends_with(amount, '.0')
  UNION ALL
  SELECT file, 'ACH-FILE-001-MIN-AMOUNT', 'FAIL',
         concat('amount_cents is below the minimum value in row ', row_no, ': ''', amount, ''''),
         'minimum: 1', concat('row ', row_no, ' value: ', amount), row_no
  FROM b_file_checked WHERE amount_cents < 1
  UNION ALL
  SELECT file, 'ACH-FILE-001-TYPE-DATE', 'FAIL',
         concat('txn_date is not in YYYY-MM-DD format in row ', row_no, ': ''', day, ''''),
         'format: YYYY-MM-DD', concat('row ', row_no, ' value: ', day), row_no
  FROM b_file_checked WHERE contains(day, '/')""",
    "b_file_status": """
  SELECT f.file, CASE WHEN count(*) FILTER (x.severity = 'FAIL') > 0 THEN 'FAIL'
                      WHEN count(x.severity) > 0 THEN 'WARNING' ELSE 'PASS' END AS status,
         count(x.severity) AS violations
  FROM b_files f LEFT JOIN b_file_findings x ON x.subject = f.file GROUP BY f.file""",
    "b_scenarios": """
  SELECT * FROM (VALUES
    ('API-BATCH-RUN-001', 'clean_trigger', 200, 'Pipeline completed successfully', NULL, NULL),
    ('API-BATCH-RUN-001', 'concurrent_trigger', 409, NULL, 'already running', NULL),
    ('API-BATCH-RUN-001', 'pipeline_failure', 500, NULL, NULL, 'Pipeline failed:'),
    ('API-BATCH-STATUS-001', 'pipeline_idle', 200, 'idle', NULL, NULL),
    ('API-BATCH-STATUS-001', 'pipeline_running', 200, 'running', NULL, NULL))
    s(contract_id, scenario, want_status, exact, part, prefix)""",
    "b_events": """
  SELECT *, CASE event_type WHEN 'purchase' THEN 'Pipeline completed successfully'
                            WHEN 'signup' THEN 'Pipeline is already running'
                            WHEN 'error' THEN 'Pipeline failed: no space left'
                            WHEN 'view' THEN 'idle' WHEN 'click' THEN 'running' END AS good
  FROM events""",
    "b_responses": """
  SELECT concat('event-', event_id) AS response_id,
         CASE WHEN event_type IN ('view', 'click') THEN 'API-BATCH-STATUS-001' ELSE 'API-BATCH-RUN-001' END AS contract_id,
         CASE event_type WHEN 'purchase' THEN 'clean_trigger' WHEN 'signup' THEN 'concurrent_trigger'
                         WHEN 'error' THEN 'pipeline_failure' WHEN 'view' THEN 'pipeline_idle'
                         WHEN 'click' THEN 'pipeline_running' END AS scenario,
         CASE WHEN event_type = 'error' THEN 500 WHEN event_type = 'signup' AND value < 100 THEN 409 ELSE 200 END AS status,
         CASE WHEN value < 150 THEN 'text/plain' WHEN value < 200 THEN 'application/json' ELSE '' END AS media,
         coalesce(CASE WHEN value < 60 THEN good WHEN value < 70 THEN props
                       WHEN value < 80 THEN concat('{"id": 0, "id": ', event_id, '}') WHEN value < 120 THEN upper(good)
                       WHEN value < 160 THEN '[' || good END, '') AS body
  FROM b_events
  UNION ALL
  SELECT concat('turn-', conv_id, '-', turn), 'API-BATCH-RUN-001', role, 200, 'text/plain', coalesce(text, '')
  FROM conversations""",
    "b_response_findings": f"""
  SELECT response_id AS subject, r.contract_id || '-' || f.kind AS rule_id, 'FAIL' AS severity,
         f.d AS description, f.e AS expected, f.a AS actual, contract_id, scenario
  FROM (SELECT r.*, unnest([
          {{'kind': 'SCENARIO-NOT-FOUND', 'bad': s.want_status IS NULL,
            'd': concat('Scenario ''', r.scenario, ''' not found in contract ', r.contract_id),
            'e': 'scenario present', 'a': 'scenario absent'}},
          {{'kind': 'STATUS', 'bad': r.status <> s.want_status,
            'd': concat('HTTP status mismatch for scenario ''', r.scenario, ''''),
            'e': concat('status: ', s.want_status), 'a': concat('status: ', r.status)}},
          {{'kind': 'CONTENT-TYPE', 'bad': s.want_status IS NOT NULL AND r.media <> 'text/plain',
            'd': concat('Content-Type mismatch for scenario ''', r.scenario, ''''),
            'e': 'content-type: text/plain', 'a': concat('content-type: ', r.media)}},
          {{'kind': 'BODY-EXACT', 'bad': r.body <> s.exact,
            'd': concat('Response body does not match expected exact value for scenario ''', r.scenario, ''''),
            'e': concat('body: "', s.exact, '"'), 'a': concat('body: "', r.body, '"')}},
          {{'kind': 'BODY-CONTAINS', 'bad': NOT contains(r.body, s.part),
            'd': concat('Response body does not contain expected substring for scenario ''', r.scenario, ''''),
            'e': concat('body contains: "', s.part, '"'), 'a': concat('body: "', r.body, '"')}},
          {{'kind': 'BODY-PREFIX', 'bad': NOT starts_with(r.body, s.prefix),
            'd': concat('Response body does not start with expected prefix for scenario ''', r.scenario, ''''),
            'e': concat('body starts with: "', s.prefix, '"'), 'a': concat('body: "', r.body, '"')}},
          {{'kind': 'PLAINTEXT',
            'bad': s.want_status IS NOT NULL AND regexp_matches(r.body, '^[\\[{{]') AND json_valid(r.body),
            'd': concat('Response body is valid JSON but contract requires plain text for scenario ''',
                        r.scenario, ''''),
            'e': 'content-type: text/plain, non-JSON body', 'a': concat('body parses as JSON: ', r.body)}}]) AS f
        FROM b_responses r LEFT JOIN b_scenarios s USING (contract_id, scenario)) r
  WHERE f.bad""",
    "b_response_status": """
  SELECT r.contract_id, r.scenario, r.responses, coalesce(f.violations, 0) AS violations,
         CASE WHEN f.violations > 0 THEN 'FAIL' ELSE 'PASS' END AS status
  FROM (SELECT contract_id, scenario, count(*) AS responses FROM b_responses GROUP BY 1, 2) r
  LEFT JOIN (SELECT contract_id, scenario, count(*) AS violations FROM b_response_findings GROUP BY 1, 2) f
       USING (contract_id, scenario)""",
    "b_expected": """
  SELECT concat('RP-', batch_id // 100) AS scenario_id, batch_id // 100 AS year, count(*) AS n,
         count(*) FILTER (message = '') AS ok,
         CAST(sum(amount_cents) FILTER (message = '') AS BIGINT) AS cents
  FROM b_legacy GROUP BY 1, 2""",
    "b_details": """
  SELECT concat('RP-', batch_id // 100) AS scenario_id, batch_id % 100 AS run_number, batch_id,
         staged_count, posted_count, staged_total_cents, posted_total_cents, counts_match, totals_match,
         counts_match AS expectation_match
  FROM b_recon""",
    "b_totals": """
  SELECT scenario_id, staged_count, posted_count, rejected_count, rejected_count AS error_count, total_posted_cents
  FROM (SELECT concat('RP-', batch_id // 100) AS scenario_id, count(*) AS staged_count,
               count(*) FILTER (status = 'rejected') AS rejected_count FROM b_table GROUP BY 1)
  JOIN (SELECT concat('RP-', batch_id // 100) AS scenario_id, count(*) AS posted_count,
               CAST(sum(amount_cents) AS BIGINT) AS total_posted_cents FROM b_faulty GROUP BY 1) USING (scenario_id)""",
    "b_seen": """
  SELECT scenario_id, count(*) AS recon_rows, bool_and(counts_match) AS counts_match,
         bool_and(totals_match) AS totals_match, bool_and(expectation_match) AS per_run_match,
         count(*) FILTER (run_number = 1) AS first_run_rows
  FROM b_details GROUP BY 1""",
    "b_replays": """
  SELECT scenario_id, recon_rows, t.staged_count, t.posted_count, t.rejected_count, t.error_count,
         t.total_posted_cents, s.counts_match, s.totals_match,
         concat_ws(' | ',
           CASE WHEN n <> staged_count THEN concat('staged count expected ', n, ' but was ', staged_count) END,
           CASE WHEN ok <> posted_count THEN concat('posted count expected ', ok, ' but was ', posted_count) END,
           CASE WHEN year <= 1998 AND n - ok <> rejected_count
                THEN concat('rejected count expected ', n - ok, ' but was ', rejected_count) END,
           CASE WHEN n - ok <> error_count THEN concat('error count expected ', n - ok, ' but was ', error_count) END,
           CASE WHEN cents <> total_posted_cents
                THEN concat('total posted cents expected ', cents, ' but was ', total_posted_cents) END,
           CASE WHEN year > 1997 AND first_run_rows <> 1
                THEN concat('reconciliation row count expected 1 but was ', first_run_rows) END,
           CASE WHEN year > 1997 AND NOT counts_match
                THEN 'reconciliation counts_match expected true but was false' END,
           CASE WHEN year <= 1997 AND NOT per_run_match
                THEN 'per-run reconciliation expectations expected true but was false' END,
           CASE WHEN n <> staged_count THEN concat('aggregate staged count expected ', n, ' but was ', staged_count) END,
           CASE WHEN ok <> posted_count THEN concat('aggregate posted count expected ', ok, ' but was ', posted_count) END,
           CASE WHEN recon_rows <> 12
                THEN concat('aggregate reconciliation row count expected 12 but was ', recon_rows) END,
           CASE WHEN NOT counts_match THEN 'aggregate eachRowCountsMatch expected true but was false' END) AS mismatches,
         concat('staged=', n, ', posted=', ok, ', rejected=',
                CASE WHEN year <= 1998 THEN CAST(n - ok AS VARCHAR) ELSE 'null' END, ', errors=', n - ok, ', total=', cents,
                CASE WHEN year <= 1997 THEN ', per-run staged=null, per-run posted=null, per-run posted-total=null'
                     ELSE ', reconRows=1' END, ', aggregateReconRows=12') AS expected_summary,
         concat('staged=', staged_count, ', posted=', posted_count, ', rejected=', rejected_count, ', errors=',
                error_count, ', total=', total_posted_cents, ', reconRows=', recon_rows, ', countsMatch=',
                CAST(counts_match AS VARCHAR), ', totalsMatch=', CAST(totals_match AS VARCHAR), ', perRunMatch=',
                CASE WHEN year <= 1997 THEN CAST(per_run_match AS VARCHAR) ELSE 'n/a' END) AS actual_summary
  FROM b_expected JOIN b_totals t USING (scenario_id) JOIN b_seen s USING (scenario_id)""",
    "b_replay_status": """
SELECT *, CASE WHEN mismatches = '' THEN 'PASS' ELSE 'FAIL' END AS status FROM b_replays""",
    "b_offenders": """
  SELECT t.batch_id >= 199801 AS late, t.*, coalesce(s.n, 0) AS now_count, coalesce(s.total, 0) AS now_total
  FROM b_tampered t LEFT JOIN (SELECT batch_id, count(*) AS n, sum(amount_cents) AS total
                               FROM b_table WHERE status = 'posted' GROUP BY 1) s USING (batch_id)""",
}

_INVARIANT_LINES = """
  SELECT 'OUTPUT-RECON-001' AS subject, rule_id, 'FAIL' AS severity,
         concat(about, ' — ', replace(text, '#', CAST(n AS VARCHAR))) AS description, expected,
         replace(actual, '#', CAST(n AS VARCHAR)) AS actual, n AS offenders
  FROM (
    SELECT 'INV-001' AS rule_id, 'counts_match must be true after a clean run with no rejected records' AS about,
           'counts_match = false in # reconciliation row(s)' AS text, 'counts_match = true' AS expected,
           'counts_match = false in # row(s)' AS actual, count(*) AS n FROM scope WHERE NOT counts_match
    UNION ALL SELECT 'INV-002', 'totals_match must be true after a clean run with no rejected records',
           'totals_match = false in # reconciliation row(s)', 'totals_match = true',
           'totals_match = false in # row(s)', count(*) FROM scope WHERE NOT totals_match
    UNION ALL SELECT 'INV-003-COUNT', 'Rejected records must be excluded from staged_count and staged_total_cents',
           'staged_count mismatch in # row(s)', 'staged_count = COUNT(staged_transactions WHERE status=''posted'')',
           'staged_count mismatch in # row(s)', count(*) FROM scope WHERE staged_count <> now_count
    UNION ALL SELECT 'INV-003-TOTAL', 'Rejected records must be excluded from staged_count and staged_total_cents',
           'staged_total_cents mismatch in # row(s)',
           'staged_total_cents = SUM(staged_transactions.amount_cents WHERE status=''posted'')',
           'staged_total_cents mismatch in # row(s)', count(*) FROM scope WHERE staged_total_cents <> now_total
    UNION ALL SELECT 'INV-004', 'Each batch_id must have exactly one reconciliation row — no duplicates on retry',
           '# batch_id(s) have more than one reconciliation row', '1 row per batch_id',
           'duplicate rows for # batch_id(s)',
           count(*) FROM (SELECT batch_id FROM scope GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'INV-005', 'staged_count and posted_count must both be >= 0',
           '# reconciliation row(s) have negative counts', 'staged_count >= 0 AND posted_count >= 0',
           'negative count in # row(s)', count(*) FROM scope WHERE staged_count < 0 OR posted_count < 0
    UNION ALL SELECT 'INV-006',
           'posted_count must never exceed staged_count — cannot post more than were staged as posted',
           '# reconciliation row(s) have posted_count > staged_count', 'posted_count <= staged_count',
           'posted_count exceeds staged_count in # row(s)', count(*) FROM scope WHERE posted_count > staged_count)
  WHERE n > 0"""

_CHECKS = """, recorded AS (
  SELECT c.*, coalesce(CASE h.rank WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARNING' END, 'PASS') AS observed_status,
         coalesce(h.violations, 0) AS violations, coalesce(h.rules, '') AS rules
  FROM (
    SELECT 'ACH-FILE-001' AS contract_id, file AS check_id,
           CASE WHEN month = 6 THEN 'WARNING' ELSE 'FAIL' END AS expected_status,
           CASE WHEN month IN (2, 10) THEN 'ACH-FILE-001-COL-MISSING' WHEN month = 4 THEN 'ACH-FILE-001-COL-EXTRA'
                WHEN month = 6 THEN 'ACH-FILE-001-COL-ORDER' WHEN month = 8 THEN 'ACH-FILE-001-DELIM' END AS expected_rule
    FROM b_files
    UNION ALL SELECT DISTINCT contract_id, scenario, 'PASS', CAST(NULL AS VARCHAR) FROM b_responses
    UNION ALL SELECT 'OUTPUT-RECON-001', 'OUTPUT-TAMPER-DETECTED', 'FAIL', 'INV-003-TOTAL') c
  LEFT JOIN (
    SELECT contract_id, check_id, max(CASE severity WHEN 'FAIL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END) AS rank,
           count(*) AS violations, string_agg(DISTINCT rule_id, ', ' ORDER BY rule_id) AS rules
    FROM (SELECT 'ACH-FILE-001' AS contract_id, subject AS check_id, severity, rule_id FROM b_file_findings
          UNION ALL SELECT contract_id, scenario, severity, rule_id FROM b_response_findings
          UNION ALL SELECT subject, 'OUTPUT-TAMPER-DETECTED', severity, rule_id FROM inv)
    GROUP BY 1, 2) h USING (contract_id, check_id)),
judged AS (
  SELECT *, CASE WHEN rules = '' THEN observed_status || ' with no violations'
                 ELSE observed_status || ' with violations: ' || rules END AS actual_outcome,
         observed_status = expected_status
           AND (expected_rule IS NULL OR list_contains(string_split(rules, ', '), expected_rule)) AS passed
  FROM recorded),
checks AS (SELECT *, CASE WHEN passed THEN 'PASS' ELSE observed_status END AS status FROM judged),
contracts AS (
  SELECT contract_id, CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAIL'
                           WHEN count(*) FILTER (status = 'WARNING') > 0 THEN 'WARNING' ELSE 'PASS' END AS status,
         count(*) AS checks, count(*) FILTER (NOT passed) AS failed_checks
  FROM checks GROUP BY 1)"""

_ALL = "scope AS (SELECT * FROM b_offenders)"
_SUITE = f", {_ALL}, inv AS ({_INVARIANT_LINES}){_CHECKS}"

_COUNTED = {
    "customers": "b_customers", "accounts": "b_accounts", "merchants": "b_merchants", "transactions": "b_faulty",
    "batch_jobs": "b_jobs", "transaction_batches": "b_batches", "batch_job_errors": "b_errors",
    "staged_transactions": "b_table", "batch_reconciliations": "b_tampered",
}


def _audit(kind: str, lines: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{kind}' AS kind, '{name}' AS constraint_name, "
        f"CAST(({count}) AS BIGINT) AS offenders"
        for table, name, count in lines
    )


def _keys() -> str:
    keys = {"customers": "customer_id", "accounts": "account_id", "merchants": "merchant_id",
            "transactions": "txn_id", "batch_jobs": "id", "transaction_batches": "id", "staged_transactions": "id"}
    return _audit("primary_key", [
        (t, k, f"SELECT count(*) FROM (SELECT {k} FROM {_COUNTED[t]} GROUP BY 1 HAVING count(*) > 1)")
        for t, k in keys.items()
    ])


def _not_nulls() -> str:
    required = {
        "customers": "customer_id full_name email created_at",
        "accounts": "account_id customer_id account_type status opened_at credit_limit_cents",
        "merchants": "merchant_id name category created_at",
        "transactions": "txn_id account_id direction amount_cents status",
        "batch_jobs": "id job_name status started_at",
        "transaction_batches": "id batch_job_id file_name status",
        "batch_job_errors": "batch_job_id error_message",
        "staged_transactions": "id batch_id account_id direction amount_cents txn_date status",
        "batch_reconciliations": "batch_id staged_count posted_count staged_total_cents posted_total_cents "
                                 "counts_match totals_match",
    }
    return _audit("not_null", [
        (t, c, f"SELECT count(*) FROM {_COUNTED[t]} WHERE {c} IS NULL") for t, cs in required.items() for c in cs.split()
    ])


def _checks() -> str:
    checks = [
        ("accounts", "accounts_account_type_check", "account_type IN ('checking', 'savings', 'credit')"),
        ("accounts", "accounts_status_check", "status IN ('active', 'frozen', 'closed')"),
        ("accounts", "accounts_credit_limit_cents_check", "credit_limit_cents >= 0"),
        ("transactions", "transactions_amount_cents_check", "amount_cents > 0"),
        ("transactions", "transactions_direction_check", "direction IN ('D', 'C')"),
        ("transactions", "transactions_status_check", "status IN ('posted', 'pending', 'reversed')"),
    ]
    return _audit("check", [(t, n, f"SELECT count(*) FROM {_COUNTED[t]} WHERE NOT ({p})") for t, n, p in checks])


def _references() -> str:
    references = [
        ("accounts", "customer_id", "customers", "customer_id"),
        ("transactions", "account_id", "accounts", "account_id"),
        ("transactions", "merchant_id", "merchants", "merchant_id"),
        ("transactions", "batch_id", "transaction_batches", "id"),
        ("transaction_batches", "batch_job_id", "batch_jobs", "id"),
        ("batch_job_errors", "batch_job_id", "batch_jobs", "id"),
        ("staged_transactions", "batch_id", "transaction_batches", "id"),
        ("staged_transactions", "merchant_id", "merchants", "merchant_id"),
        ("batch_reconciliations", "batch_id", "transaction_batches", "id"),
    ]
    return _audit("foreign_key", [
        (t, f"{c}->{p}.{k}",
         f"SELECT count(*) FROM {_COUNTED[t]} x WHERE x.{c} IS NOT NULL "
         f"AND NOT EXISTS (SELECT 1 FROM {_COUNTED[p]} y WHERE y.{k} = x.{c})")
        for t, c, p, k in references
    ])


def _status_counts(source: str) -> str:
    return ", ".join(
        f"count(*) FILTER ({source}.status = '{state}') AS {name}"
        for name, state in [("posted", "posted"), ("validated", "validated"), ("rejected", "rejected"),
                            ("still_staged", "staged")]
    )


_OUTCOME_COLUMNS = "id, batch_id, dataset_id, account_id, merchant_id, direction, amount_cents, txn_date, status"
_ENRICHED = """SELECT l.txn_id, l.account_id, c.full_name, m.name AS merchant_name, l.direction, l.amount_cents, l.status
  FROM b_ledger l JOIN b_accounts a USING (account_id) JOIN b_customers c USING (customer_id)
  LEFT JOIN b_merchants m ON m.merchant_id = l.merchant_id ORDER BY l.txn_id"""
_LIMITED = f"""SELECT batch_id, count(*) AS read_count, count(*) FILTER (status = 'validated') AS write_count,
    count(*) FILTER (status = 'rejected') AS skip_count,
    count(*) FILTER (status = 'rejected') <= {TIGHT_LIMIT} AS within_limit,
    CASE WHEN count(*) FILTER (status = 'rejected') <= {TIGHT_LIMIT} THEN 'completed' ELSE 'failed' END AS batch_status
  FROM b_outcomes GROUP BY batch_id"""
_JSON = r"""SELECT concat('{"dataset_id":"', r.dataset_id, '","description":"orders of ', r.dataset_id,
    '","commit":"unversioned","environment":"supplied orders","part":', coalesce(p.part, 0), ',"parts":',
    greatest(1, (warning_count + fail_count + approved_count + 4) // 5), ',"overall_status":"', overall_status, '","pass_count":',
    pass_count, ',"warning_count":', warning_count, ',"fail_count":', fail_count, ',"approved_count":', approved_count,
    ',"discrepancies":', coalesce(p.found, '[]'), '}') AS json
  FROM b_results r LEFT JOIN (
    SELECT dataset_id, seq // 5 AS part, CAST(to_json(list({'field': field, 'expected': expected, 'actual': actual,
      'classification': classification, 'rationale': rationale} ORDER BY seq)) AS VARCHAR) AS found
    FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY
            CASE WHEN starts_with(field, 'transactions[') THEN 1 WHEN starts_with(field, 'errors[') THEN 2 ELSE 0 END,
            TRY_CAST(regexp_extract(field, '\[([0-9]+)\]', 1) AS BIGINT) NULLS FIRST,
            list_position(['stagedCount', 'postedCount', 'rejectedCount', 'errorCount', 'totalPostedCents', 'direction',
              'amountCents', 'description'], string_split(field, '.')[-1])) - 1 AS seq FROM b_classified)
    GROUP BY 1, 2) p USING (dataset_id)"""
_DOC_HEAD = r"""SELECT CAST(doc_id AS VARCHAR) AS file,
    regexp_replace(split_part(replace(text, chr(13) || chr(10), chr(10)), chr(10), 1),
                   '^[\x{00}-\x{20}]+|[\x{00}-\x{20}]+$', '', 'g') AS head FROM documents"""
_DOC_CELLS = r"""SELECT file, unnest(list_transform(string_split(head, ','),
    lambda c: regexp_replace(c, '^[\x{00}-\x{20}]+|[\x{00}-\x{20}]+$', '', 'g'))) AS name
    FROM doc_heads WHERE contains(head, ',')"""

SELECTS: dict[str, str] = {
    "staged_scan": "SELECT *, 'staged' AS status FROM b_staged",
    "posted_of_batch": f"SELECT {_OUTCOME_COLUMNS} FROM b_table WHERE status = 'posted' AND batch_id = 199905",
    "normalize_text": f"SELECT doc_id, {squeeze('text')} AS text FROM documents",
    "normalize_conversations": f"SELECT conv_id, turn, {squeeze('text')} AS text FROM conversations",
    "job_durations": """SELECT id, epoch_us(finished_at) / 1e6 - epoch_us(started_at) / 1e6 AS duration_secs,
        CASE WHEN finished_at IS NULL THEN 'n/a'
             ELSE printf('%.1fs', epoch_us(finished_at) / 1e6 - epoch_us(started_at) / 1e6) END AS duration,
        strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started, strftime(started_at, '%Y%m%d_%H%M%S') AS stamp,
        epoch_ms(started_at) AS run_id FROM b_jobs""",
    "file_intake": """SELECT batch_id // 100 AS year, problem, count(*) AS row_count,
        CAST(sum(CASE WHEN NOT ends_with(amount, '.0') THEN amount_cents END) AS BIGINT) AS total_cents,
        min(txn_date) AS first_date, max(txn_date) AS last_date, count(problem) AS kept_lines
        FROM b_lines GROUP BY 1, 2""",
    "control_rows": f"""SELECT {RUNS[0]} AS run_id, job_name, 'completed' AS status, record_count, true AS finished FROM (
        SELECT 'load_transactions' AS job_name, count(*) AS record_count FROM b_lines WHERE problem IS NULL
        UNION ALL SELECT 'validate_transactions', count(*) FROM b_lines WHERE problem IS NULL
        UNION ALL SELECT 'post_transactions', count(*) FROM b_lines WHERE problem IS NULL AND status = 'validated'
        UNION ALL SELECT 'reconcile_batches', NULL)""",
    "run_isolation": f"""SELECT run_id, batch_id // 100 AS year, count(*) AS loaded_count,
        count(*) FILTER (status = 'rejected') AS error_count, count(*) FILTER (status = 'validated') AS ledger_count,
        count(*) FILTER (status = 'validated') AS staged_count, count(*) FILTER (status = 'validated') AS posted_count,
        CAST(coalesce(sum(amount_cents) FILTER (status = 'validated'), 0) AS BIGINT) AS staged_total_cents,
        CAST(coalesce(sum(amount_cents) FILTER (status = 'validated'), 0) AS BIGINT) AS posted_total_cents,
        true AS counts_match, true AS totals_match
        FROM b_lines, (VALUES ({RUNS[0]}), ({RUNS[1]})) r(run_id) WHERE problem IS NULL GROUP BY 1, 2""",
    "stored_year": """SELECT status, count(*) AS row_count, CAST(sum(amount_cents) AS BIGINT) AS total_cents FROM b_lines
        WHERE problem IS NULL AND batch_id // 100 = 1995 GROUP BY 1""",
    "incremental_intake": """SELECT batch_id, staged_count, staged_count AS posted_count, staged_total_cents,
        staged_total_cents AS posted_total_cents, true AS counts_match, true AS totals_match FROM b_recon""",
    "validate_rules": "SELECT id, batch_id, status, error_message FROM b_outcomes",
    "legacy_rules": """SELECT id, direction, amount_cents,
        CASE WHEN message = '' THEN 'validated' ELSE 'rejected' END AS status,
        nullif(message, '') AS error_message FROM b_legacy""",
    "reject_split": "SELECT batch_job_id, error_message, record_ref FROM b_errors",
    "accepted_rows": f"SELECT {_OUTCOME_COLUMNS} FROM b_outcomes WHERE status = 'validated'",
    "reject_limit": _LIMITED,
    "held_batches": f"""SELECT o.id, o.batch_id, CASE WHEN l.within_limit THEN o.status ELSE 'staged' END AS status,
        CASE WHEN l.within_limit THEN o.error_message END AS error_message
        FROM b_outcomes o JOIN ({_LIMITED}) l USING (batch_id)""",
    "post_ledger": "SELECT * FROM b_ledger",
    "status_merge": "SELECT id, batch_id, status FROM b_table",
    "reconcile_batches": "SELECT * FROM b_recon",
    "reconcile_both_sides": f"""SELECT batch_id, coalesce(s.n, 0) AS staged_count, coalesce(l.n, 0) AS posted_count,
        coalesce(s.total, 0) AS staged_total_cents, coalesce(l.total, 0) AS posted_total_cents,
        coalesce(s.n, 0) = coalesce(l.n, 0) AS counts_match, coalesce(s.total, 0) = coalesce(l.total, 0) AS totals_match
        FROM (SELECT batch_id, count(*) AS n, CAST(sum(amount_cents) AS BIGINT) AS total FROM b_table
              WHERE status = 'posted' AND txn_date < CAST(TIMESTAMP '{RUN_SINCE}' AS DATE) GROUP BY 1) s
        FULL JOIN (SELECT batch_id, count(*) AS n, CAST(sum(amount_cents) AS BIGINT) AS total
                   FROM b_faulty GROUP BY 1) l USING (batch_id)""",
    "reconcile_run": f"""SELECT r.* FROM b_recon r JOIN b_batches b ON b.id = r.batch_id
        JOIN b_jobs j ON j.id = b.batch_job_id
        WHERE j.job_name = 'load_transactions' AND j.started_at >= TIMESTAMP '{RUN_SINCE}'""",
    "recon_gate": """SELECT count(*) AS failed_batches, count(*) = 0 AS may_pass FROM b_recon
        WHERE NOT counts_match OR NOT totals_match""",
    "run_row_counts": f"""SELECT counter, count(t.id) AS row_count
        FROM (VALUES ('validated', 'posted'), ('validated', 'rejected'), ('posted', 'posted')) c(counter, status)
        LEFT JOIN (SELECT t.* FROM b_table t JOIN b_batches b ON b.id = t.batch_id JOIN b_jobs j ON j.id = b.batch_job_id
              WHERE j.job_name = 'load_transactions' AND j.started_at >= TIMESTAMP '{RUN_SINCE}') t USING (status) GROUP BY 1""",
    "recon_gate_run": f"""SELECT count(*) AS failed_batches, count(*) = 0 AS may_pass FROM b_tampered r
        JOIN b_batches b ON b.id = r.batch_id JOIN b_jobs j ON j.id = b.batch_job_id
        WHERE j.job_name = 'load_transactions' AND j.started_at >= TIMESTAMP '{RUN_SINCE}'
          AND (NOT counts_match OR NOT totals_match)""",
    "recon_failures": "SELECT * FROM b_recon WHERE NOT counts_match OR NOT totals_match",
    "exists_semi": """SELECT id AS batch_id, file_name FROM b_batches b
        WHERE EXISTS (SELECT 1 FROM b_table t WHERE t.batch_id = b.id AND t.status = 'posted')""",
    "distinct_batches": "SELECT DISTINCT batch_id FROM b_outcomes WHERE status = 'validated'",
    "collector_metrics": """SELECT dataset_id, staged_count, posted_count, rejected_count, error_count,
        posted_count AS ledger_count, total_posted_cents,
        posted_count = 0 OR posted_count = coalesce(l.n, 0) AS counts_match,
        posted_count = 0 OR total_posted_cents = coalesce(l.total, 0) AS totals_match
        FROM b_actual_metrics LEFT JOIN (SELECT dataset_id, count(*) AS n, CAST(sum(amount_cents) AS BIGINT) AS total
                                         FROM b_faulty GROUP BY 1) l USING (dataset_id)""",
    "collector_transactions": """SELECT dataset_id, account_id, merchant_id, direction,
        CAST(amount_cents AS BIGINT) AS amount_cents, description, CAST(txn_id AS VARCHAR) AS ref FROM b_ledger""",
    "collector_errors": "SELECT dataset_id, error_message, record_ref FROM b_errors",
    "summary_jobs": """SELECT job_name, 'completed' AS status, CAST(sum(record_count) AS BIGINT) AS record_count,
        CAST(sum(epoch_us(finished_at) - epoch_us(started_at)) AS BIGINT) / 1e6 AS duration_secs, min(id) AS first_id
        FROM b_jobs WHERE status = 'completed' GROUP BY job_name""",
    "summary_files": f"""SELECT b.id, b.file_name, b.record_count, {_status_counts('t')}
        FROM b_batches b LEFT JOIN b_table t ON t.batch_id = b.id GROUP BY b.id, b.file_name, b.record_count""",
    "summary_totals": f"SELECT count(*) AS total, {_status_counts('b_table')} FROM b_table",
    "summary_reject_reasons": "SELECT error_message, count(*) AS cnt FROM b_errors GROUP BY 1",
    "summary_recon": """SELECT r.batch_id, b.file_name, r.staged_count, r.posted_count, r.counts_match, r.totals_match,
        CASE WHEN r.counts_match AND r.totals_match THEN 'PASS' ELSE 'FAIL' END AS result
        FROM b_recon r JOIN b_batches b ON b.id = r.batch_id""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {view}" for name, view in _COUNTED.items()
    ),
    "scalar_counts": """SELECT (SELECT count(*) FROM b_customers) AS customers,
        (SELECT count(*) FROM b_accounts) AS accounts, (SELECT count(*) FROM b_merchants) AS merchants""",
    "txn_enriched_top20": f"{_ENRICHED} LIMIT 20",
    "txn_enriched": _ENRICHED,
    "list_jobs": "SELECT id, job_name, status, record_count, started_at, finished_at FROM b_jobs",
    "list_batches": "SELECT * FROM b_batches",
    "list_staged_top20": """SELECT id, batch_id, account_id, merchant_id, direction, amount_cents, status
        FROM b_table ORDER BY id LIMIT 20""",
    "list_errors_top20": "SELECT batch_job_id, error_message, record_ref FROM b_errors ORDER BY record_ref LIMIT 20",
    "list_recon": "SELECT * FROM b_recon",
    "inv_checks": f", {_ALL} {_INVARIANT_LINES}",
    "inv_scoped": f", scope AS (SELECT * FROM b_offenders WHERE late) {_INVARIANT_LINES}",
    "dup_recon": "SELECT batch_id, count(*) AS row_count FROM b_tampered GROUP BY 1 HAVING count(*) > 1",
    "pk_audit": _keys(),
    "not_null_audit": _not_nulls(),
    "check_audit": _checks(),
    "fk_audit": _references(),
    "fk_orphans": """SELECT account_id AS key, count(*) AS rows FROM b_staged s
        WHERE NOT EXISTS (SELECT 1 FROM b_accounts a WHERE a.account_id = s.account_id) GROUP BY 1""",
    "normalize_ledger": """SELECT dataset_id, account_id, merchant_id, direction, amount_cents, description, ref
        FROM b_legacy_rows""",
    "ledger_positions": "SELECT dataset_id, idx, account_id, amount_cents, direction, description FROM b_legacy_rows",
    "document_positions": """SELECT lang, n_chars, doc_id,
        row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) - 1 AS idx FROM documents""",
    "field_compare": "SELECT * FROM b_compared",
    "approval_classify": "SELECT * FROM b_classified",
    "classify_from_documents": "SELECT * FROM b_classified",
    "verification_rollup": "SELECT * FROM b_results",
    "verification_report": _JSON,
    "file_contract_rows": "SELECT * FROM b_file_findings",
    "file_contract_status": "SELECT * FROM b_file_status",
    "file_contract_documents": f""", doc_heads AS ({_DOC_HEAD}), doc_cells AS ({_DOC_CELLS})
        SELECT file AS subject, 'ACH-FILE-001-DELIM' AS rule_id, 'FAIL' AS severity,
               'File does not appear to use the contracted delimiter — header does not contain '',''' AS description,
               'delimiter: ,' AS expected, 'delimiter missing from header' AS actual, CAST(NULL AS BIGINT) AS row_no
        FROM doc_heads WHERE NOT contains(head, ',')
        UNION ALL
        SELECT file, 'ACH-FILE-001-COL-MISSING', 'FAIL', 'Required column missing from header: ' || name,
               'column present: ' || name, 'column absent', NULL
        FROM doc_heads, (VALUES ('account_id'), ('merchant_id'), ('direction'), ('amount_cents'), ('txn_date')) c(name)
        WHERE contains(head, ',')
        UNION ALL
        SELECT file, 'ACH-FILE-001-COL-EXTRA', 'WARNING',
               'Unexpected column in header: ''' || name || ''' — not in contract definition',
               'columns: [account_id, merchant_id, direction, amount_cents, txn_date]', 'extra column: ' || name, NULL
        FROM doc_cells""",
    "response_conformance": "SELECT * FROM b_response_findings",
    "response_rollup": "SELECT * FROM b_response_status",
    "replay_details": "SELECT * FROM b_details",
    "replay_compare": "SELECT * FROM b_replay_status",
    "contract_checks": f"{_SUITE} SELECT * FROM checks",
    "contract_rollup": f"{_SUITE} SELECT * FROM contracts",
    "suite_rollup": f"""{_SUITE} SELECT
        CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAIL' WHEN count(*) FILTER (status = 'WARNING') > 0
             THEN 'WARNING' ELSE 'PASS' END AS overall_status,
        count(*) FILTER (part = 1) AS contract_results, count(*) FILTER (part = 0) AS replay_results,
        count(*) FILTER (status = 'FAIL') AS failed
        FROM (SELECT status, 1 AS part FROM contracts UNION ALL SELECT status, 0 FROM b_replay_status)""",
}


def statement(select: str) -> str:
    """A select with the views it needs, in order, and no others."""
    wanted = set(re.findall(r"\bb_\w+", select))
    for name in reversed(VIEWS):
        if name in wanted:
            wanted |= set(re.findall(r"\bb_\w+", VIEWS[name]))
    views = ", ".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in wanted)
    if select.lstrip().startswith(","):
        return f"WITH {views}{select}" if views else f"WITH {select.lstrip()[1:]}"
    return f"WITH {views} {select}" if views else select


ORACLES: dict[str, str] = {name: statement(select) for name, select in SELECTS.items()}
