"""A third of all rows on one key: results stay whole, and the work is split."""

import pytest
from pyspark.sql import functions as F

from claimweave.operators import pivots, updates
from claimweave.operators.keys import keep_keys, distinct_keys
from row_sets import rows

ROWS = 60_000


@pytest.fixture
def small_partitions(spark):
    """Settings under which the test data has to be shuffled, and its hot key counts as skewed."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def hot_facts(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
    return spark.range(0, ROWS, 1, 16).select(
        F.col("id").alias("activityid"), key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("old")
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_hot_update_key_is_split(spark, small_partitions, hot_facts):
    source = hot_facts.select(F.col("k").alias("k2"), F.lit("new").alias("v")).where("k2 <> 'k1'")
    got = updates.update_from(hot_facts, source, {"k": "k2"}, {"old": "v"})
    assert "skew=true" in final_plan(got)
    assert got.count() == ROWS
    assert got.where("old = 'new'").count() == hot_facts.where("k <> 'k1'").count()


def test_hot_semi_join_key_is_split(spark, small_partitions, hot_facts):
    kept = keep_keys(hot_facts, "k", distinct_keys(hot_facts.where("activityid < 100"), "k"))
    assert "skew=true" in final_plan(kept)
    wanted = {r.k for r in hot_facts.where("activityid < 100").select("k").collect()}
    assert kept.count() == hot_facts.where(F.col("k").isin(list(wanted))).count()


def test_null_keys_are_spread_in_an_update(spark, small_partitions, hot_facts):
    facts = hot_facts.withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    source = facts.select(F.col("k").alias("k2"), F.lit("new").alias("v"))
    got = updates.update_from(facts, source, {"k": "k2"}, {"old": "v"})
    nulls = F.count(F.when(F.col("k").isNull(), 1)).alias("nulls")
    sizes = [r.nulls for r in got.groupBy(F.spark_partition_id()).agg(nulls).collect()]
    assert sum(sizes) == facts.where("k is null").count() and len(sizes) >= 4
    assert max(sizes) < sum(sizes) / 3


def test_hot_visit_in_the_pivots(spark, hot_facts):
    diagnosis = hot_facts.select(
        F.col("k").alias("visit_id"),
        F.element_at(F.array(F.lit("P"), F.lit("S"), F.lit("V")), (F.col("activityid") % 7 % 3 + 1).cast("int")).alias("diag_type"),
        F.substring("old", 1, 6).alias("icd_code"),
        F.col("activityid").cast("string").alias("id"),
    )
    hot = [tuple(r) for r in diagnosis.where("visit_id = 'hot'").collect()]
    principal = max(c for _, t, c, _ in hot if t == "P")
    secondary = [c for c, _ in sorted((c, i) for _, t, c, i in hot if t == "S")][:15]
    got = pivots.diag_pivot_typed(diagnosis).where("visit_id = 'hot'").first()
    assert list(got[1:]) == [principal, *secondary]
    ordered = sorted((t, c, i) for _, t, c, i in hot)[:16]
    assert list(pivots.diag_pivot_positional(diagnosis).where("visit_id = 'hot'").first()[1:]) == [c for _, c, _ in ordered]


def test_wide_table_plan_has_no_pair_joins(spark):
    from claimweave.registry.queries import QUERIES

    for name in ("claim_wide", "patients_by_keys", "diagnoses_by_keys", "claims_per_param_row", "stage_diagnoses"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
    facts = QUERIES["claim_wide"](spark, "/root/testdata/sf0.001")
    assert len(rows(facts)) == facts.count()
