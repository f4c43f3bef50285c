"""Column helpers; every one is a built-in expression, so it stays inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control characters up to the blank, and the characters that count as whitespace.
CONTROLS = "".join(chr(c) for c in range(0x21))
WHITESPACE = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x1680, *range(0x2000, 0x2007), *range(0x2008, 0x200B),
              0x2028, 0x2029, 0x205F, 0x3000]
)


def control_trim(text: Column) -> Column:
    """Cut every character up to U+0020 from both ends."""
    return F.btrim(text, F.lit(CONTROLS))


def is_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE)) == ""


def squeeze(text: Column) -> Column:
    """Strip both ends, then turn inner runs of whitespace into one blank; null stays null."""
    return F.regexp_replace(F.btrim(text, F.lit(WHITESPACE)), r"\s+", " ")


def pad_trim(text: Column) -> Column:
    """Take pad blanks off a fixed-width code; an absent code is an empty one."""
    return F.coalesce(F.trim(text), F.lit(""))


def intake_date(text: Column) -> Column:
    """A date written as 2025-03-10 or as 3/7/2025 (month first)."""
    clean = F.trim(text)
    return F.coalesce(F.try_to_date(clean, "yyyy-MM-dd"), F.try_to_date(clean, "M/d/yyyy"))


def strict_int(text: Column) -> Column:
    """A 32-bit integer with an optional sign, else null."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def strict_date(text: Column) -> Column:
    """An existing day in the form 2025-03-10, else null."""
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def media_type(header: Column) -> Column:
    """The bare media type of a content-type header; absent or blank gives an empty text."""
    return F.coalesce(F.lower(control_trim(F.substring_index(header, ";", 1))), F.lit(""))


def is_json_document(body: Column) -> Column:
    """Whether a body holds a JSON object or array; repeated members and text after its end do not matter."""
    return (
        F.when(body.startswith("{"), F.json_object_keys(body).isNotNull())
        .when(body.startswith("["), F.json_array_length(body).isNotNull())
        .otherwise(F.lit(False))
    )


def elapsed_micros(started: Column, finished: Column) -> Column:
    return F.unix_micros(finished) - F.unix_micros(started)


def seconds_label(seconds: Column) -> Column:
    return F.when(seconds.isNull(), "n/a").otherwise(F.format_string("%.1fs", seconds))


def stamp(ts: Column, style: str = "report") -> Column:
    """Render a timestamp for a report line, a file name or an ISO field."""
    pattern = {"report": "yyyy-MM-dd HH:mm:ss", "file": "yyyyMMdd_HHmmss", "iso": "yyyy-MM-dd'T'HH:mm:ss"}[style]
    return F.date_format(ts, pattern)


def run_started(run_id: Column) -> Column:
    return F.timestamp_millis(run_id)


def run_id_of(ts: Column) -> Column:
    return F.unix_millis(ts)


def pass_label(*checks: Column) -> Column:
    return F.when(reduce(lambda a, b: a & b, checks), "PASS").otherwise("FAIL")


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("bigint"))


def severity_rank(label: Column, scale: list[str]) -> Column:
    """Position of a severity on its scale, mildest 0."""
    return F.array_position(F.array(*[F.lit(s) for s in scale]), label).cast("int") - 1


def severity_label(rank: Column, scale: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in scale]), rank + 1)


def worst(label: Column, scale: list[str]) -> Column:
    """Aggregate: the worst severity of a group, or the mildest for an empty one."""
    return severity_label(F.coalesce(F.max(severity_rank(label, scale)), F.lit(0)), scale)


def all_true(flag: Column) -> Column:
    """Aggregate: true when no row says false, also for no rows at all."""
    return F.coalesce(F.bool_and(F.coalesce(flag, F.lit(False))), F.lit(True))


def text_list(items: Column) -> Column:
    """Aggregate: the distinct values in order, as one text."""
    return F.array_join(F.array_sort(F.collect_set(items)), ", ")


def within_expectation(expected: Column, actual: Column) -> Column:
    """An absent expectation is not checked."""
    return expected.isNull() | (expected == actual)


def explode_findings(frame: DataFrame, candidates: list[Column], *keep: str) -> DataFrame:
    """One row per candidate finding that is not null.

    The candidates are filtered in a projection of their own, as one generated method holding them
    all would be too large for the JIT compiler. The outer explode keeps Catalyst from inferring a
    size filter, which would carry a second copy of every candidate down into the joins below.
    """
    present = F.filter(F.array(*candidates), lambda f: f.isNotNull())
    found = frame.select(*keep, present.alias("found")).select(*keep, F.explode_outer("found").alias("f"))
    return found.where(F.col("f").isNotNull()).select("f.*", *keep)


def finding(subject: Column, rule: Column, severity: str, text: Column, expected: Column, actual: Column) -> Column:
    return F.struct(
        subject.cast("string").alias("subject"),
        rule.alias("rule_id"),
        F.lit(severity).alias("severity"),
        text.alias("description"),
        expected.alias("expected"),
        actual.alias("actual"),
    )
