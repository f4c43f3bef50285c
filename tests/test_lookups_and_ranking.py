import random

import pytest
from pyspark.sql import functions as F

from tillstone.operators.lookups import in_scope, lookup_join, orphan_counts
from tillstone.operators.ranking import positional_index


@pytest.fixture
def shuffled(spark):
    """No reference table counts as small, and any key with 50 rows as hot."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _rows():
    rng = random.Random(7)
    keys = [1] * 400 + [None] * 300 + [rng.randrange(2, 60) for _ in range(500)]
    return [(i, k) for i, k in enumerate(keys)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, shuffled, how):
    facts = spark.createDataFrame(_rows(), "id INT, k INT")
    reference = spark.createDataFrame([(k, f"v{k}") for k in range(0, 50)], "k INT, v STRING")
    got = lookup_join(facts, reference, "k", how, hot_rows=50)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    want = facts.join(reference, "k", how)
    assert sorted(map(str, got.select("id", "k", "v").collect())) == sorted(
        map(str, want.select("id", "k", "v").collect())
    )


def test_small_reference_is_broadcast(spark):
    facts = spark.createDataFrame(_rows(), "id INT, k INT")
    reference = spark.range(50).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("v"))
    plan = lookup_join(facts, reference, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_salt" not in plan


def test_scope_and_orphans(spark, shuffled):
    facts = spark.createDataFrame(_rows(), "id INT, k INT")
    scope = spark.createDataFrame([(1,), (1,), (5,)], "k INT")
    assert in_scope(facts, scope, "k").count() == facts.where("k in (1, 5)").count()
    parents = spark.createDataFrame([(k,) for k in range(2, 60)], "p INT")
    assert [tuple(r) for r in orphan_counts(facts, "k", parents, "p").collect()] == [(1, 400)]


def test_positions_of_a_hot_group(spark):
    """One group holds most rows and most of those share their sort key; positions stay exact."""
    rng = random.Random(3)
    rows = [("hot", 5 if i % 3 else rng.randrange(10), i) for i in range(3000)]
    rows += [(f"g{i % 40}", rng.randrange(5), 10_000 + i) for i in range(800)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "g STRING, v INT, u INT").repartition(7)
    got = {(r.g, r.u): r.idx for r in positional_index(frame, ["g"], ["v"], ["u"]).collect()}
    groups = {}
    for g, v, u in rows:
        groups.setdefault(g, []).append((v, u))
    want = {(g, u): i for g, members in groups.items() for i, (_, u) in enumerate(sorted(members))}
    assert got == want


def test_hot_group_spreads_over_partitions(spark):
    frame = spark.range(20_000).select(F.lit("hot").alias("g"), (F.col("id") % 3).alias("v"), F.col("id").alias("u"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid_out = frame.repartitionByRange("g", "v", "u")
        sizes = [r["count"] for r in laid_out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 10_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_measured_reference_is_broadcast(spark, shuffled):
    """An aggregated reference with a useless estimate is counted and then broadcast."""
    facts = spark.createDataFrame(_rows(), "id INT, k INT")
    reference = facts.where("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    got = lookup_join(facts, reference, "k", measure=True)
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    assert got.where("k = 1 and n = 400").count() == 400 and got.count() == facts.count()
