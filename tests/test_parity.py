"""Every registered query against its SQL counterpart, on the smallest supplied tables."""

import os

import pytest

import __spark_entry__ as entry_point
from tillstone.operators import lookups
from tillstone.plans.catalog import QUERIES
from tillstone.plans.oracles import ORACLES
from parity import compare, connect

FOLDER = os.environ.get("PARITY_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, text = compare(spark, con, FOLDER, name, QUERIES[name], ORACLES[name])
    assert ok, text


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", ["validate_rules", "reconcile_run", "held_batches", "txn_enriched", "inv_scoped", "field_compare",
             "file_contract_rows", "response_conformance", "replay_details"]
)
def test_without_broadcasts(spark, con, monkeypatch, name):
    """The same results when no table counts as small and most keys as hot."""
    monkeypatch.setattr(lookups, "HOT_ROWS", 20)
    monkeypatch.setattr(lookups, "MEASURED_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ok, text = compare(spark, con, FOLDER, name, QUERIES[name], ORACLES[name])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ok, text
