"""Exact duplicates through an extendible-hash index kept in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstone.llm.textkit import text_or_empty
from tillstone.session import cut_lineage

# Rows of a bucket before it is split. A parameter of the layout; results do not depend on it.
BUCKET_ROWS = 8_192
# The directory is doubled up to this many bits. For tables with more than BUCKET_ROWS << MAX_DEPTH rows the
# buckets are made larger instead, so the directory and the list of hot keys never pass 1 << MAX_DEPTH entries.
MAX_DEPTH = 20
# Bits beyond those that equal buckets would need. A bucket still overfull after them holds a rare cluster of keys.
SPARE_BITS = 4
_SPACES = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]


def squeeze(text: Column) -> Column:
    """The text without the characters x20 and x09 to x0D."""
    for blank in _SPACES:
        text = F.replace(text, F.lit(blank))
    return text


def _prefix(key: str, depth: int) -> Column:
    """The first `depth` bits of the hash key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("bigint")


def directory(loads: DataFrame, capacity: int, levels: int) -> tuple[int, DataFrame]:
    """The directory of keys (key, load): the global depth, and the bucket and its local depth for each slot.

    The load of every bucket of every depth is summed in one pass. A bucket is split only if it is overfull and holds
    more than one key, `levels` times at most, so a bucket is there if it fits while the one it was split from did not.
    The deepest bucket gives the global depth, and a bucket of a lesser depth has several slots.
    """
    leaves = loads.groupBy(_prefix("key", levels).alias("leaf")).agg(
        F.sum("load").alias("load"), F.min("key").alias("least"), F.max("key").alias("most")
    )
    every = leaves.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    tally = every.groupBy("depth", F.expr(f"shiftright(leaf, {levels} - depth)").alias("prefix")).agg(
        F.sum("load").alias("load"), F.min("least").alias("least"), F.max("most").alias("most")
    ).withColumn("overfull", (F.col("load") > capacity) & (F.col("least") < F.col("most")) & (F.col("depth") < levels))
    tally = cut_lineage(tally.select("depth", "prefix", "overfull"))
    split = tally.where("overfull").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    fitting = tally.where("NOT overfull").withColumn("parent", F.expr("shiftright(prefix, 1)"))
    buckets = fitting.join(split, ["depth", "parent"], "left_semi").unionByName(fitting.where("depth = 0")).select("depth", "prefix")
    deepest = buckets.agg(F.max("depth")).first()[0] or 0
    first = F.expr(f"shiftleft(prefix, {deepest} - depth)")
    last = F.expr(f"shiftleft(prefix + 1, {deepest} - depth) - 1")
    return deepest, buckets.select(F.explode(F.sequence(first, last)).alias("slot"), first.alias("bucket"), "depth")


def build_index(docs: DataFrame, capacity: int = BUCKET_ROWS, key_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One entry per different normalised text: bucket, depth, key, chain, text_sha256, keep_id, group_size.

    1. Rows are counted per hash key. A key with more rows than a bucket holds is hot and weighs one.
    2. The directory is doubled; only overfull buckets are split (`directory`).
    3. Each row goes by the directory to the owner of its bucket, which is a range of keys. The owner puts the rows of a
       key in order, compares their bytes, and writes one entry per different text: the row that stays and the size of
       the group. Texts that only share a key follow each other as a chain.
    4. Rows of hot keys are compared and merged where they are read, and meet their owner as partial entries.

    The directory and the list of hot keys have at most 1 << MAX_DEPTH entries each, so both are broadcast.
    """
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.length(text).alias("points"), squeeze(text).alias("body")
    ).withColumn("key", key_of(F.col("body")))
    counts = cut_lineage(rows.groupBy("key").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    capacity = max(capacity, -(-total >> MAX_DEPTH))
    hot = F.col("n") > capacity
    loads = counts.select("key", F.when(hot, 1).otherwise(F.col("n")).alias("load"))
    bits, slots = directory(loads, capacity, min(MAX_DEPTH, (total // capacity).bit_length() + SPARE_BITS))
    placed = rows.withColumn("slot", _prefix("key", bits)).join(F.broadcast(slots), "slot").drop("slot")
    listed = F.broadcast(counts.where(hot).select("key"))
    best = F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"))
    in_chain = Window.partitionBy("bucket", "key").orderBy("text_sha256")

    def entries(part: DataFrame) -> DataFrame:
        grouped = part.groupBy("bucket", "depth", "key", "body").agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
        lean = grouped.select("bucket", "depth", "key", F.sha2("body", 256).alias("text_sha256"), F.col("best.id").alias("keep_id"), "group_size")
        return lean.withColumn("chain", (F.row_number().over(in_chain) - 1).cast("int"))

    # After the move by bucket the grouping and the chains need no further exchange.
    owned = entries(placed.join(listed, "key", "left_anti").repartition("bucket"))
    return cut_lineage(owned.unionByName(entries(placed.join(listed, "key", "left_semi"))))


def exact_groups(docs: DataFrame, capacity: int = BUCKET_ROWS, key_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Texts are equal when the same after white space (x20, x09 to x0D) is deleted. Of equal texts the row
    with the most code points stays, then the one with the smallest doc_id. Null texts count as empty,
    and all empty texts are one group. Rows that repeat a doc_id together with its text share one
    decision. A row without doc_id stays only if its whole group has none or if it is the longest; then
    keep_id is null. An empty table gives no rows; other columns are not read.

    The index gives the answer: a row finds the chain of its key and in it the entry with its digest, by a join whose
    large side holds ids and hashes only; a hot key is split there by the adaptive skew join.
    """
    index = build_index(docs, capacity, key_of)
    body = squeeze(text_or_empty())
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("body")).select(
        "doc_id", key_of(F.col("body")).alias("key"), F.sha2("body", 256).alias("text_sha256")
    )
    return rows.join(index.select("key", "text_sha256", "keep_id", "group_size"), ["key", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
