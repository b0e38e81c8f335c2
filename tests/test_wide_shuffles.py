import re

from pyspark.sql import functions as F

from claimweave.operators.keys import key_join
from claimweave.plans.claim_wide import build_claim_wide
from claimweave.registry.queries import AS_OF, FIRST_DAY, LAST_DAY, Entities


def shuffled_columns(df):
    """Numbers of columns below the shuffles of a plan, in no order."""
    found = []

    def visit(node):
        if node.nodeName() == "Exchange":
            found.append([re.sub(r"#.*", "", node.output().apply(i).toString()) for i in range(node.output().size())])
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(df._jdf.queryExecution().executedPlan().initialPlan())
    return found


def test_masters_come_before_what_widens_facts(spark):
    """With no broadcast, every join shuffles the facts: only those by which little follows may carry observations and diagnoses."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        e = Entities(spark, "/root/testdata/sf0.001")
        columns = shuffled_columns(build_claim_wide(e.claim_fact, e.sources(), FIRST_DAY, LAST_DAY, "", AS_OF))
        for wide, most in (("encounterdiagnosissecondary9", 3), ("obscode5", 5)):
            assert 0 < sum(wide in c for c in columns) <= most
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_hashes_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = spark.range(9).select("id", F.lit("x").alias("v")), spark.range(9).select(F.col("id").alias("k"), F.lit("y").alias("w"))
        joined = key_join(left, right, {"id": "k"}, "left")
        assert len(shuffled_columns(joined)) == 2 and not any("hash" in c for columns in shuffled_columns(joined) for c in columns)
        assert joined.where("w = 'y'").count() == 9
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
