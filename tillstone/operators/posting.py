"""Post accepted rows to the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.functions.scalars import pad_trim
from tillstone.model import LEDGER_DESCRIPTION, POSTED_STATE, VALIDATED_STATE
from tillstone.sources.tables import with_status


def post(validated: DataFrame) -> DataFrame:
    """Ledger rows for the validated rows; the transaction date stays behind."""
    extra = [c for c in ("dataset_id", "scenario_id", "run_id", "file_key") if c in validated.columns]
    return validated.where(F.col("status") == VALIDATED_STATE).select(
        F.col("id").alias("txn_id"),
        "account_id",
        "merchant_id",
        pad_trim(F.col("direction")).alias("direction"),
        "amount_cents",
        F.lit(POSTED_STATE).alias("status"),
        F.lit(LEDGER_DESCRIPTION).alias("description"),
        "batch_id",
        *extra,
    )


def mark_posted(outcomes: DataFrame) -> DataFrame:
    """The staged table after posting: validated rows are posted, rejected ones keep their state."""
    return with_status(outcomes, [(F.col("status") == VALIDATED_STATE, POSTED_STATE)])
