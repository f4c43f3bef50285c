"""Reproducible shuffle into shards by a keyed permutation of global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstone.llm.textkit import text_or_empty
from tillstone.session import cut_lineage

ROUNDS = 6
ROW_BYTES = 16
# A prime below 2**31: products of two remainders fit a long.
_PRIME = 2_147_483_647
_PLACE_BITS = 33


def _halves(rows: int) -> tuple[int, int]:
    left = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    return left, max(1, -(-rows // left))


def _round_key(seed: int, turn: int) -> tuple[int, int]:
    add = (seed * 1_000_003 + turn * 7_919 + 12_345) % _PRIME
    return add, (add * 48_271 + 11) % _PRIME


def _walks(rows: int) -> int:
    """Enough steps: below 4096 rows the walk cannot be longer, above that each step stays outside with a
    chance under 1/64."""
    return min(_halves(rows)[0], 64) + 1


def permute(number: Column, rows: int, seed: int, back: bool = False) -> Column:
    """Place of a row number in the permutation of 0 .. rows-1 (`back`: the row number of a place).

    A Feistel network over Z_a x Z_b with a * b >= rows and a * b - rows < a. Places at or past `rows`
    are sent through the network again until they fall inside (cycle walking), which keeps it a
    permutation of exactly `rows` numbers.
    """
    left, right = _halves(rows)
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(k[0]).cast("bigint").alias("add"), F.lit(k[1]).cast("bigint").alias("by"))
                     for t in (range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)) for k in [_round_key(seed, t)]])

    def spread(value: Column, key: Column) -> Column:
        once = (value + key["add"]) % _PRIME
        twice = (once * once + value * (key["by"] % 65_521)) % _PRIME
        return (twice * twice + key["by"]) % _PRIME

    def turn(pair: Column, key: Column) -> Column:
        sign = -1 if back else 1
        even = key["t"] % 2 == 0
        return F.struct(
            F.when(even, F.pmod(pair["l"] + sign * spread(pair["r"], key), F.lit(left))).otherwise(pair["l"]).alias("l"),
            F.when(even, pair["r"]).otherwise(F.pmod(pair["r"] + sign * spread(pair["l"], key), F.lit(right))).alias("r"),
        )

    def network(place: Column) -> Column:
        pair = F.struct((place % left).alias("l"), F.floor(place / left).cast("bigint").alias("r"))
        return F.aggregate(keys, pair, turn, lambda p: p["r"] * left + p["l"])

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(_walks(rows))), network(number.cast("bigint")),
        lambda place, _: F.when(place < rows, place).otherwise(network(place)),
    )
    return F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("bigint"))


def number_rows(frame: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """Gapless row numbers from 0 in the given order.

    Rows are range-partitioned and the layout is written to the shared folder once; one count per
    range partition then gives each partition's first number. Equal rows may swap numbers.
    """
    laid = cut_lineage(
        frame.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", _PLACE_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition, whatever the number of rows.
    starts = laid.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    within = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    return laid.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + within).drop("_at", "_part", "_start")


def assign_shards(docs: DataFrame, shards: int = 40, seed: int = 7) -> DataFrame:
    """Shard and slot of every row, from its global row number alone.

    Law `rows`: row number -> permuted place p -> shard p % shards, slot p div shards; so shard sizes
    differ by one row at most, slots have no gaps, and either direction is computable without a table.
    Rows are numbered by (doc_id, text checksum, size): the result depends on the data and the seed,
    not on files or partitions. Copies of a text are not kept together, as a group of copies may be
    larger than a shard.

    Null text: size 16, checksum 0, like an empty text. Null doc_id: numbered first. Repeated rows each
    take a place. An empty table gives no rows. Other columns are not read. Only ids, sizes and
    checksums are shuffled, never texts.
    """
    text = text_or_empty()
    lean = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    numbered = number_rows(lean, ["doc_id", "text_crc32", "size"])
    rows = numbered.count()
    place = permute(F.col("row_no"), rows, seed)
    return numbered.withColumn("_place", place).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("_place") % shards).cast("int").alias("shard"),
        F.floor(F.col("_place") / shards).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_no",
    )


def row_of(shard: Column, slot: Column, rows: int, shards: int = 40, seed: int = 7) -> Column:
    """The row number that sits in a given slot of a given shard."""
    return permute(slot.cast("bigint") * shards + shard, rows, seed, back=True)
