"""Field-by-field comparison of run outputs with golden baselines, for many datasets at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.scalars import is_blank, severity_rank, severity_label, squeeze
from tillstone.model import VERIFICATION_SEVERITIES
from tillstone.operators.lookups import in_scope
from tillstone.operators.ranking import positional_index
from tillstone.operators.reconciliation import Outputs
from tillstone.session import cut_lineage

KEY = "dataset_id"
TRANSACTIONS, ERRORS = "transactions", "errors"
# Findings in one part of a dataset's report; a dataset with more gets several numbered parts.
PART_FINDINGS = 1000
# Rows of a list in one baseline document.
PART_ROWS = 100_000

# Compared fields and the columns behind them, in report order.
SCALAR_FIELDS = [
    ("stagedCount", "staged_count"),
    ("postedCount", "posted_count"),
    ("rejectedCount", "rejected_count"),
    ("errorCount", "error_count"),
    ("totalPostedCents", "total_posted_cents"),
]
TRANSACTION_FIELDS = [("direction", "direction"), ("amountCents", "amount_cents"), ("description", "description")]


def baseline_outputs(documents: DataFrame) -> Outputs:
    """Baseline documents in the shape of collected outputs; the first part of a dataset has its figures."""
    documents = documents.withColumn("part", F.coalesce("part", F.lit(0))) if "part" in documents.columns else documents.withColumn("part", F.lit(0))
    metrics = documents.where("part = 0").select(
        F.col("datasetId").alias(KEY),
        F.col("description").alias("dataset_description"),
        F.col("stagedCount").cast("bigint").alias("staged_count"),
        F.col("postedCount").cast("bigint").alias("posted_count"),
        F.col("rejectedCount").cast("bigint").alias("rejected_count"),
        F.col("errorCount").cast("bigint").alias("error_count"),
        F.col("totalPostedCents").alias("total_posted_cents"),
        F.col("reconciliation.countsMatch").alias("counts_match"),
        F.col("reconciliation.totalsMatch").alias("totals_match"),
    )
    place = F.concat(F.lpad(F.col("part").cast("string"), 10, "0"), F.lit("-"), F.lpad(F.col("at").cast("string"), 10, "0"))
    transactions = documents.select(F.col("datasetId").alias(KEY), "part", F.posexplode("transactions").alias("at", "t")).select(
        KEY,
        F.col("t.accountId").alias("account_id"),
        F.col("t.merchantId").alias("merchant_id"),
        F.col("t.direction").alias("direction"),
        F.col("t.amountCents").alias("amount_cents"),
        F.col("t.description").alias("description"),
        place.alias("ref"),
    )
    errors = documents.select(F.col("datasetId").alias(KEY), F.explode("errors").alias("e")).select(
        KEY, F.col("e.errorMessage").alias("error_message"), F.col("e.recordRef").alias("record_ref")
    )
    return Outputs(metrics, transactions, errors)


def baseline_documents(outputs: Outputs, part_rows: int = PART_ROWS) -> DataFrame:
    """Collected outputs as baseline documents: figures, transactions and errors of a dataset nested in one row.

    A dataset whose lists are longer than `part_rows` becomes several documents with parts numbered from 0, of which the
    first has the figures, so no list outgrows a task. Transactions are in the order of their references.
    """
    def nested(rows: DataFrame, order: list[str], name: str, entry: Column) -> DataFrame:
        numbered = positional_index(rows, [KEY], order)
        listed = F.array_sort(F.collect_list(F.struct("idx", entry.alias("entry"))))
        part = F.floor(F.col("idx") / part_rows).cast("int").alias("part")
        return numbered.groupBy(KEY, part).agg(F.transform(listed, lambda x: x["entry"]).alias(name))

    transaction = F.struct(
        F.col("account_id").alias("accountId"), F.col("merchant_id").alias("merchantId"), "direction",
        F.col("amount_cents").alias("amountCents"), "description",
    )
    error = F.struct(F.col("error_message").alias("errorMessage"), F.col("record_ref").alias("recordRef"))
    figures = outputs.metrics.select(
        KEY, F.lit(0).alias("part"), F.col("staged_count").alias("stagedCount"), F.col("posted_count").alias("postedCount"),
        F.col("rejected_count").alias("rejectedCount"), F.col("error_count").alias("errorCount"),
        F.col("total_posted_cents").alias("totalPostedCents"),
        F.struct(F.col("counts_match").alias("countsMatch"), F.col("totals_match").alias("totalsMatch")).alias("reconciliation"),
    )
    parts = figures.join(nested(outputs.transactions, ["ref"], "transactions", transaction), [KEY, "part"], "full")
    parts = parts.join(nested(outputs.errors, ["record_ref", "error_message"], "errors", error), [KEY, "part"], "full")
    return parts.withColumnRenamed(KEY, "datasetId")


def normalize_transactions(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"direction": squeeze(F.col("direction")), "description": squeeze(F.col("description"))})


def normalize_errors(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"error_message": squeeze(F.col("error_message")), "record_ref": squeeze(F.col("record_ref"))}
    )


def index_transactions(rows: DataFrame, *outer: str) -> DataFrame:
    """Normalised rows with their place by account and amount; ties go by direction and text."""
    return positional_index(
        normalize_transactions(rows), [*outer, KEY],
        ["account_id", "amount_cents", "direction", "description"], ["ref"],
    )


def index_errors(rows: DataFrame, *outer: str) -> DataFrame:
    """Normalised messages with their place in message order, an absent message first."""
    keyed = normalize_errors(rows).withColumn("_by", F.coalesce("error_message", F.lit("")))
    return positional_index(keyed, [*outer, KEY], ["_by"], ["record_ref"]).drop("_by")


def _both_sides(actual: DataFrame, baseline: DataFrame, columns: list[str]) -> DataFrame:
    """Both lists in one frame, so that one sorted layout serves them."""
    parts = [f.select(KEY, *columns, F.lit(side).alias("side")) for f, side in ((actual, "a"), (baseline, "b"))]
    return parts[0].unionByName(parts[1])


def _paired(indexed: DataFrame, columns: list[str]) -> DataFrame:
    """Both sides of every place in one row, by one aggregate; a side without that place is null."""
    def of(side: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.struct(*columns))).alias(side)

    return indexed.groupBy(KEY, "kind", "idx").agg(of("b"), of("a"))


def _entry(field: Column, expected: Column, actual: Column, equal: Column) -> Column:
    return F.struct(
        field.alias("field"), expected.cast("string").alias("expected"), actual.cast("string").alias("actual"),
        equal.alias("equal"),
    )


def compare_fields(actual: Outputs, baseline: Outputs) -> DataFrame:
    """Every compared field: dataset_id, field, expected, actual, equal.

    A dataset that only one side knows is compared with zeros. Rows are compared only where both sides
    posted the same number; then a baseline row without a counterpart meets nulls. Messages are compared
    pair by pair as far as both lists reach.
    """
    have = F.struct(*[F.col(c).alias(c) for _, c in SCALAR_FIELDS])
    nothing = F.struct(*[F.lit(0).cast("bigint").alias(c) for _, c in SCALAR_FIELDS])
    sides = baseline.metrics.select(KEY, have.alias("b")).join(actual.metrics.select(KEY, have.alias("a")), KEY, "full")
    # One row per dataset, used three times below.
    both = cut_lineage(sides.select(KEY, F.coalesce("b", nothing).alias("b"), F.coalesce("a", nothing).alias("a")))
    scalars = both.select(KEY, F.explode(F.array(*[
        _entry(F.lit(field), F.col(f"b.{c}"), F.col(f"a.{c}"), F.col(f"b.{c}") == F.col(f"a.{c}"))
        for field, c in SCALAR_FIELDS
    ])).alias("e"))

    level = both.where(F.col("b.posted_count") == F.col("a.posted_count")).select(KEY)
    listed = _both_sides(
        actual.transactions, baseline.transactions,
        ["account_id", "amount_cents", "direction", "description", "ref"],
    )
    rows = normalize_transactions(in_scope(listed, level, KEY)).withColumn("kind", F.lit(TRANSACTIONS))
    texts = normalize_errors(_both_sides(actual.errors, baseline.errors, ["error_message", "record_ref"]))
    texts = texts.withColumnRenamed("record_ref", "ref").withColumns(
        {"kind": F.lit(ERRORS), "text": F.coalesce("error_message", F.lit(""))}
    )
    # Both lists of both sides share one sorted layout; rows go by account and amount, messages by text.
    ranked = positional_index(
        rows.unionByName(texts, allowMissingColumns=True), ["kind", "side", KEY],
        ["account_id", "amount_cents", "direction", "description", "text"], ["ref"],
    )
    pairs = _paired(ranked, [*(c for _, c in TRANSACTION_FIELDS), "error_message"])

    def entry(label: str, column: str) -> Column:
        place = F.concat(F.col("kind"), F.lit("["), F.col("idx").cast("string"), F.lit("]."), F.lit(label))
        want, got = F.col(f"b.{column}"), F.col(f"a.{column}")
        return _entry(place, want, got, want.eqNullSafe(got))

    is_row = F.col("kind") == TRANSACTIONS
    entries = F.when(is_row, F.array(*[entry(field, c) for field, c in TRANSACTION_FIELDS])).otherwise(
        F.array(entry("errorMessage", "error_message"))
    )
    met = pairs.where(F.col("b").isNotNull() & (is_row | F.col("a").isNotNull()))
    return scalars.unionByName(met.select(KEY, F.explode(entries).alias("e"))).select(KEY, "e.*")


def _covers(approval: str) -> Column:
    """Whether an approval entry covers a finding; a null on either side meets any contained text."""
    def part(value: str, pattern: str) -> Column:
        v, p = F.col(value), F.col(f"{approval}.{pattern}")
        return v.isNull() | p.isNull() | v.contains(p)

    contains = part("expected", "expectedValue") & part("actual", "actualValue")
    exact = F.col("expected").eqNullSafe(F.col(f"{approval}.expectedValue")) & F.col("actual").eqNullSafe(
        F.col(f"{approval}.actualValue")
    )
    return F.when(F.col(f"{approval}.matchType") == "contains", contains).otherwise(exact)


def classify(compared: DataFrame, approvals: DataFrame) -> DataFrame:
    """Findings with their class: the first listed approval that covers one decides.

    A field occurs once per dataset, so (dataset_id, field) spreads evenly over the shuffle.
    """
    findings = compared.where(~F.col("equal")).select(KEY, "field", "expected", "actual")
    entries = approvals.select(
        F.col("dataset_id").alias(KEY), "field",
        F.struct("entry_ord", "expectedValue", "actualValue", "matchType", "approvedBy", "rationale").alias("ap"),
    )
    joined = findings.join(entries, [KEY, "field"], "left")
    usable = F.when(F.col("ap").isNotNull() & _covers("ap"), F.col("ap"))
    chosen = joined.groupBy(KEY, "field", "expected", "actual").agg(
        F.min_by(usable, F.when(usable.isNotNull(), F.col("ap.entry_ord"))).alias("ap")
    )
    signed = F.col("ap.approvedBy").isNotNull() & ~is_blank(F.col("ap.approvedBy"))
    return chosen.select(
        KEY, "field", "expected", "actual",
        F.when(F.col("ap").isNull(), "FAIL").when(signed, "APPROVED_DIFFERENCE").otherwise("WARNING").alias(
            "classification"
        ),
        F.col("ap.rationale").alias("rationale"),
    )


def verification_results(compared: DataFrame, classified: DataFrame) -> DataFrame:
    """Counts by class and the worst class per dataset."""
    passes = compared.groupBy(KEY).agg(F.count_if("equal").alias("pass_count"))
    kind = F.col("classification")
    found = classified.groupBy(KEY).agg(
        F.count_if(kind == "WARNING").alias("warning_count"),
        F.count_if(kind == "FAIL").alias("fail_count"),
        F.count_if(kind == "APPROVED_DIFFERENCE").alias("approved_count"),
        F.max(severity_rank(kind, VERIFICATION_SEVERITIES)).alias("rank"),
    )
    counts = ["warning_count", "fail_count", "approved_count"]
    return passes.join(found, KEY, "left").select(
        KEY,
        severity_label(F.coalesce("rank", F.lit(0)), VERIFICATION_SEVERITIES).alias("overall_status"),
        "pass_count",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
    )


def verify(actual: Outputs, baseline: Outputs, approvals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classified findings and the result per dataset."""
    compared = cut_lineage(compare_fields(actual, baseline))
    classified = cut_lineage(classify(compared, approvals))
    return classified, verification_results(compared, classified)


def _report_order() -> list[Column]:
    """Findings in the order of comparison: single figures, then rows by place, then messages by place."""
    field = F.col("field")
    kinds = F.when(field.startswith(f"{TRANSACTIONS}["), 1).when(field.startswith(f"{ERRORS}["), 2).otherwise(0)
    place = F.regexp_extract(field, r"\[([0-9]+)\]", 1).try_cast("bigint")
    names = F.array(*[F.lit(name) for name, _ in [*SCALAR_FIELDS, *TRANSACTION_FIELDS]])
    return [kinds, place, F.array_position(names, F.substring_index(field, ".", -1))]


def report(
    results: DataFrame, classified: DataFrame, descriptions: DataFrame, metadata: dict[str, str], part_findings: int = PART_FINDINGS
) -> DataFrame:
    """The verification report: per dataset its description, the given metadata (such as commit and environment), result
    and counts, and the list of discrepancies in the order of comparison.

    Findings are numbered over a sorted layout, so a dataset with very many is not brought into one task; each
    `part_findings` of them make a part, and all parts repeat the head. `descriptions` has dataset_id and
    description; a dataset without one has null there.
    """
    numbered = positional_index(classified, [KEY], _report_order())
    found = F.struct("idx", "field", "expected", "actual", "classification", "rationale")
    parts = numbered.groupBy(KEY, F.floor(F.col("idx") / part_findings).alias("part")).agg(F.array_sort(F.collect_list(found)).alias("found"))
    total = F.greatest(F.lit(1), F.ceil((F.col("warning_count") + F.col("fail_count") + F.col("approved_count")) / part_findings))
    head = results.join(descriptions.select(KEY, "description"), KEY, "left").withColumn("parts", total)
    nothing = parts.schema["found"].dataType.simpleString()
    listed = F.transform(
        F.coalesce("found", F.array().cast(nothing)),
        lambda f: F.struct(*[f[c].alias(c) for c in ("field", "expected", "actual", "classification", "rationale")]),
    )
    return head.join(parts, KEY, "left").select(
        KEY, "description", *[F.lit(value).alias(name) for name, value in metadata.items()],
        F.coalesce("part", F.lit(0)).alias("part"), "parts", "overall_status",
        "pass_count", "warning_count", "fail_count", "approved_count", listed.alias("discrepancies"),
    )
