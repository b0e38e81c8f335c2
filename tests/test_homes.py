import random

from pyspark.sql import functions as F

from claimweave.operators import homes
from claimweave.operators.keys import key_join
from claimweave.operators.pivots import diag_pivot_typed
from claimweave.plans.claim_wide import build_claim_wide
from claimweave.registry.queries import AS_OF, FIRST_DAY, LAST_DAY, Entities
from row_sets import rows
from test_wide_shuffles import shuffled_columns


def test_facts_are_shuffled_once_for_all_sources_that_grow(spark):
    """With no broadcast, facts are shuffled by home, and for the three masters that stay small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        e = Entities(spark, "/root/testdata/sf0.001")
        columns = shuffled_columns(build_claim_wide(e.claim_fact, e.sources(), FIRST_DAY, LAST_DAY, "", AS_OF))
        assert sum("activityid" in c for c in columns) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_homes_give_what_joins_give(spark, tmp_path, monkeypatch):
    """Null, hot, repeated and unknown keys, identical rows; homes of one, four and all rows, and parts of few rows."""
    rng = random.Random(7)
    made = [(rng.choice("xyz"), rng.choice([None, "hot", "hot", "1", "2", "never"]), rng.choice([None, "a", "b", "c"])) for _ in range(300)]
    facts = spark.createDataFrame(made, "v string, k string, j string").repartition(5)
    by_k = spark.createDataFrame([(1, "one"), (2, None), (None, "no"), (7, "unasked")], "k2 int, kv string").select(F.col("k2").cast("string"), "kv")
    hot = spark.createDataFrame([("hot", "h")], by_k.schema)
    first, second = by_k.union(hot), spark.createDataFrame([("hot", 5), ("2", None), (None, 6)], "k3 string, kw int")
    by_j = spark.createDataFrame([("a", 1.5), ("c", None)], "j2 string, jv double")
    wanted = key_join(key_join(key_join(facts, first, {"k": "k2"}, "left"), second, {"k": "k3"}, "left"), by_j, {"j": "j2"}, "left")
    for bits, most in ((0, 7), (2, 50), (20, 1 << 17)):
        monkeypatch.setattr(homes, "HOME_BITS", bits)
        path = f"{tmp_path}/facts-{bits}"
        homes.with_homes(facts).write.parquet(path)
        at = homes.Homes(spark.read.parquet(path), most)
        got = at.join(at.meet(at.dealt(), "k", (first, "k2"), (second, "k3")), by_j, {"j": "j2"}).drop(homes.HOME)
        assert got.columns == wanted.columns and rows(got) == rows(wanted)


def test_keys_of_homes_compare_as_text(spark, tmp_path):
    homes.with_homes(spark.createDataFrame([("7", 1), ("8", 2)], "k string, n int")).write.parquet(f"{tmp_path}/facts")
    at = homes.Homes(spark.read.parquet(f"{tmp_path}/facts"))
    got = at.join(at.dealt(), spark.createDataFrame([(7, "y")], "k2 int, v string"), {"k": "k2"})
    assert rows(got.select("k", "n", "v")) == [("7", 1, "y"), ("8", 2, None)]


def test_a_home_holds_a_bounded_number_of_rows(spark):
    sizes = homes.with_homes(spark.range(0, 1000, 1, 3)).groupBy(homes.HOME).count().collect()
    assert max(r["count"] for r in sizes) == 1 << homes.HOME_BITS


def test_typed_pivot_shuffles_codes_only(spark):
    """Equal codes fill equal slots in any order, so what else tells diagnoses apart is not shuffled."""
    e = Entities(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        widest = max(shuffled_columns(diag_pivot_typed(e.diagnosis)), key=lambda c: "kind" in c)
        assert "kind" in widest and len(widest) == 4 and "id" not in widest
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_typed_pivot_of_rows_without_code_type_or_visit(spark):
    codes = [f"c{i:02d}" for i in range(20)]
    made = [("v", "S", c, str(i)) for i, c in enumerate(reversed(codes))] + [("v", "S", "c00", "x"), ("v", "S", None, "y")]
    made += [("v", "P", c, str(i)) for i, c in enumerate(codes)] + [("v", "P", None, "z")]
    made += [("w", "S", None, "1"), ("w", "P", None, "2"), ("x", "V", "c1", "3"), ("y", None, "c2", "4"), (None, "P", "c3", "5"), ("z", "S", "c4", None)]
    got = {r[0]: list(r[1:]) for r in diag_pivot_typed(spark.createDataFrame(made, "visit_id string, diag_type string, icd_code string, id string")).collect()}
    none = [None] * 16
    assert got == {"v": ["c19", "c00", *codes[:14]], "w": none, "x": none, "y": none, None: ["c3", *none[1:]], "z": [None, "c4", *none[2:]]}
