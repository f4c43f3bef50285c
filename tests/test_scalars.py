import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillstone.functions import scalars as S
from tillstone.model import CONTRACT_SEVERITIES, VERIFICATION_SEVERITIES


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_squeeze_strips_then_collapses(spark):
    assert one(spark, S.squeeze(F.lit("\t Batch \n posted "))) == "Batch posted"
    assert one(spark, S.squeeze(F.lit(None).cast("string"))) is None
    assert one(spark, S.squeeze(F.lit(" x"))) == " x"


@pytest.mark.parametrize(
    "text, value", [("5", 5), ("+5", 5), ("-7", -7), ("5.0", None), ("3000000000", None), ("5e2", None), ("", None),
                    ("abc", None), ("0000000000012", 12)]
)
def test_strict_int(spark, text, value):
    assert one(spark, S.strict_int(F.lit(text))) == value


@pytest.mark.parametrize(
    "text, ok", [("2025-03-10", True), ("2025-3-10", False), ("10/03/2025", False), ("2025-02-30", False),
                 ("2025-03-10T00", False)]
)
def test_strict_date(spark, text, ok):
    assert (one(spark, S.strict_date(F.lit(text))) is not None) == ok


def test_intake_date_takes_both_forms(spark):
    assert one(spark, S.intake_date(F.lit("2025-03-10"))) == dt.date(2025, 3, 10)
    assert one(spark, S.intake_date(F.lit("3/7/2025"))) == dt.date(2025, 3, 7)
    assert one(spark, S.intake_date(F.lit("soon"))) is None


def test_media_type(spark):
    assert one(spark, S.media_type(F.lit("Text/Plain; charset=UTF-8"))) == "text/plain"
    assert one(spark, S.media_type(F.lit("  "))) == ""
    assert one(spark, S.media_type(F.lit(None).cast("string"))) == ""


@pytest.mark.parametrize(
    "body, is_json", [('{"a":1}', True), ("[1]", True), ("{broken", False), ("5", False), ("idle", False), ("", False),
                      ('{"a":1,"a":2}', True), ('{"a":1} rest', True), ('{"a":{"b":}}', False), ("[1, {]", False), ("[idle", False)]
)
def test_json_probe(spark, body, is_json):
    assert one(spark, S.is_json_document(F.lit(body))) is is_json


def test_durations_and_stamps(spark):
    a, b = F.lit("2025-03-10 01:00:00").cast("timestamp"), F.lit("2025-03-10 01:00:02.5").cast("timestamp")
    assert one(spark, S.elapsed_micros(a, b)) == 2_500_000
    assert one(spark, S.seconds_label(S.elapsed_micros(a, b) / 1e6)) == "2.5s"
    assert one(spark, S.seconds_label(F.lit(None).cast("double"))) == "n/a"
    assert one(spark, S.stamp(a, "file")) == "20250310_010000"
    assert one(spark, S.stamp(a, "iso")) == "2025-03-10T01:00:00"
    assert one(spark, S.run_id_of(S.run_started(F.lit(1741568400123)))) == 1741568400123


def test_severity_scales(spark):
    rows = spark.createDataFrame([("PASS",), ("WARNING",), ("FAIL",)], "s STRING")
    assert rows.agg(S.worst(F.col("s"), CONTRACT_SEVERITIES).alias("w")).first().w == "FAIL"
    assert rows.where("s = 'none'").agg(S.worst(F.col("s"), CONTRACT_SEVERITIES).alias("w")).first().w == "PASS"
    two = spark.createDataFrame([("APPROVED_DIFFERENCE",), ("WARNING",)], "s STRING")
    assert two.agg(S.worst(F.col("s"), VERIFICATION_SEVERITIES).alias("w")).first().w == "WARNING"


def test_all_true_of_nothing(spark):
    empty = spark.createDataFrame([], "b BOOLEAN")
    assert empty.agg(S.all_true(F.col("b")).alias("x")).first().x is True
    mixed = spark.createDataFrame([(True,), (None,)], "b BOOLEAN")
    assert mixed.agg(S.all_true(F.col("b")).alias("x")).first().x is False
