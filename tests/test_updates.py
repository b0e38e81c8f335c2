import random

from pyspark.sql import functions as F

from claimweave.operators import updates
from claimweave.operators.keys import key_join, one_per_key
from claimweave.plans.claim_wide import ClaimSources, build_claim_wide, select_claims
from claimweave.registry.queries import AS_OF, Entities
from claimweave.operators.pivots import diag_pivot_typed, obs_pivot
from row_sets import rows

TARGET = "id int, k string, old string"


def test_match_takes_nulls_and_no_match_keeps(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (4, None, "x")], TARGET)
    source = spark.createDataFrame([("a", "new"), ("b", None), (None, "never")], "k2 string, v string")
    got = updates.update_from(target, source, {"k": "k2"}, {"old": "v", "added": "v"})
    assert got.columns == ["id", "k", "old", "added"]
    assert rows(got) == [(1, "a", "new", "new"), (2, "b", None, None), (3, "c", "x", None), (4, None, "x", None)]


def test_several_source_rows_give_one_update(spark):
    target = spark.createDataFrame([(1, "a", "x")], TARGET)
    source = spark.createDataFrame([("a", "2", 5), ("a", "9", 1), ("a", None, 9)], "k2 string, v string, rank int")
    assert rows(updates.update_from(target, source, {"k": "k2"}, {"old": "v"})) == [(1, "a", "2")]
    assert rows(updates.update_from(target, source, {"k": "k2"}, {"old": "v"}, order_by=["rank"])) == [(1, "a", "9")]


def test_keys_compare_as_text(spark):
    target = spark.createDataFrame([(1, "7", "x")], TARGET)
    source = spark.createDataFrame([(7, "y")], "k2 int, v string")
    assert rows(updates.update_from(target, source, {"k": "k2"}, {"old": "v"})) == [(1, "7", "y")]


def test_update_never_changes_the_row_count(spark):
    rng = random.Random(3)
    keys = [None, "a", "b", "c", "d"]
    target = spark.createDataFrame([(i, rng.choice(keys), "x") for i in range(200)], TARGET)
    source = spark.createDataFrame([(rng.choice(keys), str(rng.random())) for _ in range(30)], "k2 string, v string")
    got = updates.update_from(target, source, {"k": "k2"}, {"old": "v"})
    first = {}
    for k, v in sorted((tuple(r) for r in source.where("k2 is not null").collect())):
        first.setdefault(k, v)
    assert rows(got) == sorted(((r.id, r.k, first.get(r.k, "x")) for r in target.collect()), key=repr)


def test_missing_department_blocks_the_doctor_update(spark):
    registration = spark.createDataFrame(
        [("v1", "d1"), ("v2", "d2"), ("v3", "d9")], "patient_id string, doctor string"
    ).selectExpr("*", "DATE '2024-01-01' AS reg_date", "'10:00:00' AS reg_time", "'s' AS transfer_source", "'t' AS transfer_destination")
    doctor = spark.createDataFrame([("d1", "Dr A", "1"), ("d2", "Dr B", "2")], "doctor_id string, doctor_name string, dept_id string")
    department = spark.createDataFrame([("1", "Eye")], "dept_id string, dept_name string")
    claims = spark.createDataFrame([("v1", "old"), ("v2", "old"), ("v3", "old")], "visit_id string, doctorname string")
    got = updates.update_doctor(claims, registration, doctor, department).select("visit_id", "doctorname", "doctorsdepartment")
    assert rows(got) == [("v1", "Dr A", "Eye"), ("v2", "old", None), ("v3", "old", None)]


def test_unmatched_claim_keeps_its_own_principal_diagnosis(spark):
    claims = spark.createDataFrame([("v1", "I10"), ("v2", "I11")], "visit_id string, encounterdiagnosisprincipal string")
    diagnosis = spark.createDataFrame([("v1", "S", "E11", "1")], "visit_id string, diag_type string, icd_code string, id string")
    got = updates.update_diagnosis(claims, diag_pivot_typed(diagnosis))
    assert rows(got.select("visit_id", "encounterdiagnosisprincipal", "encounterdiagnosissecondary1")) == [
        ("v1", None, "E11"),
        ("v2", "I11", None),
    ]


def test_one_pass_equals_the_updates_one_by_one(spark):
    e = Entities(spark, "/root/testdata/sf0.001")
    src: ClaimSources = e.sources()
    wide = build_claim_wide(e.claim_fact, src, "1995-01-01", "2001-12-31", "", AS_OF)
    claims = select_claims(e.claim_fact, "1995-01-01", "2001-12-31")
    claims = updates.update_center(claims, src.center)
    claims = updates.update_tpa(claims, src.tpa)
    claims = updates.update_plan(claims, src.plan, src.category)
    claims = updates.update_rate_plan(claims, src.organization)
    claims = updates.update_insurer(claims, src.insurance_company)
    claims = updates.update_observations(claims, obs_pivot(src.observation))
    claims = updates.update_doctor(claims, src.registration, src.doctor, src.department)
    claims = updates.update_diagnosis(claims, diag_pivot_typed(src.diagnosis))
    claims = updates.update_patient(claims, src.patient, AS_OF)
    assert wide.columns == claims.columns
    assert rows(wide) == rows(claims)


def test_key_join_kinds(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    right = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "k2 string, v string")
    on = {"k": "k2"}
    assert rows(key_join(left, right, on)) == [(1, "a", "x"), (1, "a", "y")]
    assert rows(key_join(left, right, on, "left")) == [(1, "a", "x"), (1, "a", "y"), (2, "b", None), (3, None, None)]
    assert rows(key_join(left, right, on, "left_semi")) == [(1, "a")]
    assert rows(key_join(left, right, on, "left_anti")) == [(2, "b"), (3, None)]


def test_one_per_key_orders_nulls_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 7, 3)], "k string, r int, v int")
    assert rows(one_per_key(df, ["k"], ["r"])) == [("a", 5, 2)]
    assert one_per_key(df.select("k"), ["k"]).count() == 1
