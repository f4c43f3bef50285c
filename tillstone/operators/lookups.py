"""Joins from a large table to a reference table, safe for hot keys and for absent keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.session import cut_lineage

HOT_ROWS = 1_000_000
SPREAD = 64
# A reference table that was written out and counted may be broadcast up to this size.
MEASURED_BYTES = 256 << 20


def broadcast_limit(frame: DataFrame) -> int:
    setting = frame.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    digits = setting.rstrip("bkmgtp")
    unit = setting[len(digits):].removesuffix("b")
    return int(digits) << 10 * ["", "k", "m", "g", "t", "p"].index(unit)


def estimated_bytes(frame: DataFrame) -> int:
    """Catalyst's own size estimate; it never starts a job and errs on the large side."""
    return int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(frame: DataFrame) -> bool:
    return estimated_bytes(frame) <= broadcast_limit(frame)


def row_bytes(frame: DataFrame) -> int:
    """A generous guess at the size of a row in memory."""
    return 32 + sum(8 if f.dataType.typeName() in _FIXED else 128 for f in frame.schema.fields)


_FIXED = {"boolean", "byte", "short", "integer", "long", "double", "date", "timestamp", "timestamp_ntz"}


def lookup_join(
    facts: DataFrame,
    reference: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    hot_rows: int | None = None,
    measure: bool = False,
) -> DataFrame:
    """Join facts to a reference table that has one row (or few) per key.

    A reference table proven small is broadcast: by Catalyst's estimate or, with `measure`, by
    writing it out and counting it, which suits results of an aggregation whose estimate is far too
    high. Otherwise both sides shuffle, and keys holding many fact rows, as well as absent keys, are
    spread over SPREAD salts. Every key of HOT_ROWS rows or more is on the hot-key list, which so has at
    most one entry per HOT_ROWS fact rows. Every row is joined either way.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported lookup join: {how}")
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(reference):
        return facts.join(F.broadcast(reference), keys, how)
    if measure:
        reference = cut_lineage(reference)
        if reference.count() * row_bytes(reference) <= MEASURED_BYTES:
            return facts.join(F.broadcast(reference), keys, how)

    hot = (
        facts.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") >= (hot_rows or HOT_ROWS))
        .select(*keys, F.lit(True).alias("_hot"))
    )
    absent = F.lit(False)
    for key in keys:
        absent = absent | F.col(key).isNull()
    spread = F.pmod(F.xxhash64(*facts.columns), F.lit(SPREAD)).cast("int")
    salted_facts = facts.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot") | absent, spread).otherwise(F.lit(0))
    ).drop("_hot")
    salted_reference = reference.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt",
        F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))),
    ).drop("_hot")
    return salted_facts.join(salted_reference, [*keys, "_salt"], how).drop("_salt")


def in_scope(frame: DataFrame, scope: DataFrame, key: str) -> DataFrame:
    """Keep the rows whose key is listed in `scope` (the IN-list filter, without a literal list)."""
    listed = scope.select(key).distinct().withColumn("_listed", F.lit(True))
    return lookup_join(frame, listed, key, "inner", measure=True).drop("_listed")


def orphan_counts(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values without a parent row and how many child rows carry each of them.

    Child rows are counted per key first, so a hot key reaches the join as a single row.
    """
    counted = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(
        F.count("*").alias("rows")
    )
    return counted.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def having_rows(frame: DataFrame, predicate: Column, key: str) -> DataFrame:
    """Keys with at least one row meeting the predicate (the EXISTS test)."""
    return frame.where(predicate).select(key).distinct()
