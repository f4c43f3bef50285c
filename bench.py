"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tillstone.plans.catalog import QUERIES
from tillstone.session import build_session, drop_scratch

HEADLINE = [
    "staged_scan", "normalize_text", "validate_rules", "reject_split", "reject_limit", "held_batches", "post_ledger",
    "status_merge", "reconcile_batches", "reconcile_run", "recon_gate", "collector_metrics", "summary_jobs",
    "summary_files", "summary_totals", "summary_reject_reasons", "summary_recon", "table_counts",
    "txn_enriched_top20", "inv_checks", "pk_audit", "not_null_audit", "check_audit", "fk_audit", "ledger_positions",
    "field_compare", "approval_classify", "verification_rollup", "verification_report", "classify_from_documents", "stored_year", "file_contract_rows", "file_contract_documents",
    "response_conformance", "replay_compare", "run_isolation", "incremental_intake", "suite_rollup",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One warm-up pass over the main chain, so code generation and class loading are not timed.
    QUERIES["reconcile_batches"](spark, folder).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
        drop_scratch(spark)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
