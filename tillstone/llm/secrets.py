"""Secret scan over content-addressed texts with a ledger of what was scanned under which rules."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstone.llm.textkit import text_or_empty
from tillstone.session import cut_lineage, scratch_path

# What was counted to take at most this much in memory is broadcast; an address and a span there take about so much.
BROADCAST_BYTES = 64 << 20
ADDRESS_BYTES = 256
SPAN_BYTES = 64
# Characters of a text that are masked at a time.
MASK_BLOCK = 1 << 14


class Rule(NamedTuple):
    """A pattern, the group whose length counts, and the least length; shorter matches are dropped."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


# The three base rules, in the order that breaks ties. A run of the hex class below 32 and an
# access id below 16 characters can be no finding, so their least lengths are part of the pattern.
RULES = (
    Rule("assign", 1, "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", 1, "AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", 1, "[0-9a-f]{32,}", 0, 32),
)
LEDGER_SCHEMA = "blob STRING, kind STRING, version INT, spans ARRAY<STRUCT<start: INT, end: INT>>"


def find_cells(text: Column, rule: Rule) -> Column:
    """Lengths in code points around all matches of a rule, leftmost and without overlap: gap, hit and part.

    The pieces between the matches and the matches themselves are cut by one pattern; `part` is what must not be
    too short. The last cell has a gap only. A text without a match has no cells.
    """
    zipped = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("part"),
    )
    cells = F.transform(zipped, lambda c: F.struct(*[F.coalesce(F.length(c[k]), F.lit(0)).alias(k) for k in ("gap", "hit", "part")]))
    return F.when(text.rlike(rule.pattern), cells).otherwise(F.expr("CAST(array() AS ARRAY<STRUCT<gap: INT, hit: INT, part: INT>>)"))


def address(docs: DataFrame) -> DataFrame:
    """Every version with the address of its content; a null text counts as empty."""
    return docs.withColumn("blob", F.sha2(text_or_empty(), 256))


def _pair(rule: Rule) -> Column:
    return F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"))


def _unseen(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob and open, the (kind, version) pairs the ledger does not have, of blobs with any; addresses only."""
    wanted = F.lit(False)
    for r in rules:
        wanted = wanted | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    done = ledger.where(wanted).groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("done"))
    known = versions.select("blob").distinct().join(done, "blob", "left")
    none = F.expr("CAST(array() AS ARRAY<STRUCT<kind: STRING, version: INT>>)")
    left = known.select("blob", F.array_except(F.array(*map(_pair, rules)), F.coalesce("done", none)).alias("open"))
    return left.where(F.size("open") > 0)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows (blob, kind, version, spans): each text once, under each rule version it has not met.

    The pairs still to do are worked out on addresses alone; only texts with at least one open pair are scanned, and
    where those are few no other text is moved. Copies merge by content before they are shuffled. A blob without findings gets
    an empty list, so it counts as seen. The place of a finding is a running sum over the lengths before it.
    """
    versions = versions.select("blob", text_or_empty().alias("text"))
    once = F.min("text").alias("text")
    if ledger is None:
        todo = versions.groupBy("blob").agg(once).withColumn("open", F.array(*map(_pair, rules)))
    else:
        unseen = cut_lineage(_unseen(versions, ledger, rules))
        if unseen.count() * ADDRESS_BYTES <= BROADCAST_BYTES:
            todo = versions.join(F.broadcast(unseen.select("blob")), "blob", "left_semi").groupBy("blob").agg(once).join(F.broadcast(unseen), "blob")
        else:
            todo = versions.groupBy("blob").agg(once).join(unseen, "blob")
    cells = F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.lit(r.least).alias("least"),
                 F.when(F.array_contains("open", _pair(r)), find_cells(F.col("text"), r)).alias("cells"))
        for r in rules
    ])
    key = ["blob", "kind", "version"]
    per_rule = todo.select("blob", F.explode(F.filter(cells, lambda x: x["cells"].isNotNull())).alias("x")).select("blob", "x.*")
    cell = per_rule.select(*key, "least", F.posexplode_outer("cells").alias("at", "cell")).select(*key, "least", "at", "cell.*")
    # All of these keep to the partitioning by blob that the merge of copies has made.
    before = Window.partitionBy(*key).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cell.withColumn("end", F.sum(F.col("gap") + F.col("hit")).over(before).cast("int"))
    span = F.struct((F.col("end") - F.col("hit")).alias("start"), F.col("end").alias("end"))
    return placed.groupBy(*key).agg(F.sort_array(F.collect_list(F.when(F.col("part") >= F.col("least"), span))).alias("spans"))


def findings(versions: DataFrame, scanned: DataFrame, carry: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Join the findings of each blob back to all its paths: carry columns, blob, spans (start, end, kind).

    Blobs without findings never take part in the join; `spans` is then empty. Spans are ordered by
    start, then by the order of the rules. Findings that were counted to be few are broadcast, so the
    carried columns stay where they are. Ledger rows written twice count once.
    """
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    cell = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), rank[F.col("kind")].alias("rank"), s["end"].alias("end"), F.col("kind").alias("kind")))
    found = scanned.where((F.size("spans") > 0) & current)
    by_blob = cut_lineage(found.select("blob", cell.alias("cells")).groupBy("blob").agg(
        F.sort_array(F.flatten(F.collect_set("cells"))).alias("cells")
    ))
    size = by_blob.agg(F.count("*"), F.coalesce(F.sum(F.size("cells")), F.lit(0))).first()
    if size[0] * ADDRESS_BYTES + size[1] * SPAN_BYTES <= BROADCAST_BYTES:
        by_blob = F.broadcast(by_blob)
    none = F.expr("CAST(array() AS ARRAY<STRUCT<start: INT, rank: INT, end: INT, kind: STRING>>)")
    return versions.select(*carry, "blob").join(by_blob, "blob", "left").select(*carry, "blob", F.coalesce("cells", none).alias("spans"))


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table as it is now. The append of no rows makes the table where there is none yet."""
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def scan_secrets(docs: DataFrame, carry: list[str], ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of every row; rows sharing a text share one scan. Repeated rows each get their findings.

    `ledger` is the path of a ledger table in the shared folder that is kept between runs. It is read before the
    scan, the pairs of blob and rule version it lacks are scanned and appended, and all findings are taken from it. A
    run that ends before its append is committed leaves the ledger as it was. Without a path the run has a new
    ledger of its own there and scans every blob.

    Null or empty texts have none. An empty table gives no rows. Carried columns named `blob` or `spans`
    are not allowed; other columns are not read.
    """
    spark = docs.sparkSession
    path = ledger or scratch_path(spark, "secret-ledger")
    versions = address(docs.select(*dict.fromkeys([*carry, "text"])))
    scan_unseen(versions, open_ledger(spark, path), rules).write.mode("append").parquet(path)
    return findings(versions, spark.read.schema(LEDGER_SCHEMA).parquet(path), carry, rules)


def mask(text: Column, spans: Column, sign: str = "*") -> Column:
    """The text with every character of a span overwritten; spans are ordered by start and may overlap.

    Worked out in blocks of MASK_BLOCK characters, each with the spans that reach into it.
    """

    # A block's own text and spans are made once, before they are walked through.
    def cut(number: Column) -> Column:
        first = number * MASK_BLOCK
        inside = F.filter(spans, lambda s: (s["end"] > first) & (s["start"] < first + MASK_BLOCK))
        near = F.transform(inside, lambda s: F.struct(
            F.greatest(s["start"] - first, F.lit(0)).alias("start"), F.least(s["end"] - first, F.lit(MASK_BLOCK)).alias("end")))
        return F.struct(F.substring(text, first + 1, F.lit(MASK_BLOCK)).alias("part"), near.alias("near"))

    def cover(cell: Column) -> Column:
        def step(state: Column, span: Column) -> Column:
            begin, end = F.greatest(span["start"], state["at"]), F.greatest(span["end"], state["at"])
            clear = F.substring(cell["part"], state["at"] + 1, begin - state["at"])
            return F.struct(end.alias("at"), F.concat(state["out"], clear, F.repeat(F.lit(sign), end - begin)).alias("out"))

        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        return F.aggregate(cell["near"], start, step, lambda s: F.concat(s["out"], F.substring(cell["part"], s["at"] + 1, F.lit(MASK_BLOCK))))

    last = F.floor(F.greatest(F.length(text) - 1, F.lit(0)) / MASK_BLOCK).cast("int")
    return F.array_join(F.transform(F.transform(F.sequence(F.lit(0), last), cut), cover), "")
