"""Transaction-batch analytics on Spark: intake, validation, posting, reconciliation, audits."""
