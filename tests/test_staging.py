"""Staging joins against plain Python over small, deliberately messy frames."""

import random
from datetime import date, datetime

import pytest

from claimweave.operators import staging
from claimweave.operators.keys import distinct_keys
from claimweave.operators.projections import PATIENT_PART, REGISTRATION_PART
from claimweave.schemas import DIAGNOSIS, OBSERVATION, PATIENT, REGISTRATION
from row_sets import rows

PERIOD = ("2024-01-10", "2024-01-20")
CENTERS = "1,2,9"


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(9)

    def maybe(value):
        return None if rng.random() < 0.08 else value

    made = {
        "batch": [(f"b{i}", maybe(datetime(2024, 1, rng.randrange(5, 26), rng.randrange(24)))) for i in range(12)],
        "header": [(maybe(f"b{rng.randrange(14)}"), maybe(f"v{rng.randrange(30)}")) for _ in range(60)],
        "registration": [
            (maybe(f"m{rng.randrange(12)}"), f"v{i}", maybe(str(rng.randrange(1, 5))), date(2024, 1, 1), "10:00:00", "d", "x", "s", None)
            for i in range(25)
        ],
        "patient": [(f"m{i}", f"N{i}", *[None] * 8) for i in range(10)],
        "center": [(1, "one"), (2, "two"), (3, "three")],
        "diagnosis": [(maybe(f"v{rng.randrange(30)}"), str(i), None, f"I{i}", "c", "S") for i in range(80)],
        "observation": [(maybe(f"c{rng.randrange(10)}"), "t", f"o{i}", None, None) for i in range(40)],
        "bill": [(f"n{i}", maybe(datetime(2024, 1, rng.randrange(5, 26), 23, 59))) for i in range(8)],
        "bill_charge": [(maybe(f"c{rng.randrange(12)}"), f"n{rng.randrange(9)}") for _ in range(30)],
    }
    schemas = {
        "batch": "submission_batch_id string, submission_date timestamp_ntz",
        "header": "submission_batch_id string, patient_id string",
        "registration": REGISTRATION,
        "patient": PATIENT,
        "center": "center_id int, center_name string",
        "diagnosis": DIAGNOSIS,
        "observation": OBSERVATION,
        "bill": "bill_no string, finalized_date timestamp_ntz",
        "bill_charge": "charge_id string, bill_no string",
    }
    return made, {n: spark.createDataFrame(made[n], s) for n, s in schemas.items()}


def in_period(moment):
    return moment is not None and date(2024, 1, 10) <= moment.date() <= date(2024, 1, 20)


def visits_of(made):
    return [
        r
        for b, day in made["batch"] if in_period(day)
        for hb, hv in made["header"] if hb == b
        for r in made["registration"] if r[1] == hv and r[2] in ("1", "2")
    ]


def staged(frames):
    return staging.staged_visits(
        frames["batch"], frames["header"], frames["registration"], frames["center"], CENTERS, *PERIOD
    )


def test_staged_visits(world):
    made, frames = world
    expected = visits_of(made)
    assert len(expected) > len(set(expected)) > 3
    assert rows(staged(frames)) == sorted(expected, key=repr)
    registrations = staging.stage_registrations(staged(frames))
    assert registrations.columns == REGISTRATION_PART and registrations.count() == len(expected)


def test_staged_patients_are_distinct(world):
    made, frames = world
    known = {r[0] for r in visits_of(made)}
    got = staging.stage_patients(staged(frames), frames["patient"].union(frames["patient"]))
    assert got.columns == PATIENT_PART
    assert sorted(r.mr_no for r in got.collect()) == sorted(p[0] for p in made["patient"] if p[0] in known)


def test_staged_diagnoses(world):
    made, frames = world
    expected = [d for v in visits_of(made) for d in made["diagnosis"] if d[0] == v[1]]
    assert rows(staging.stage_diagnoses(staged(frames), frames["diagnosis"])) == sorted(expected, key=repr)


def test_observations_of_final_bills(world):
    made, frames = world
    final = {n for n, day in made["bill"] if in_period(day)}
    expected = [o for o in made["observation"] for c, n in made["bill_charge"] if n in final and c is not None and c == o[0]]
    got = staging.stage_observations_by_bill(frames["observation"], frames["bill_charge"], frames["bill"], *PERIOD)
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("centers", [CENTERS, "", "9"])
def test_patients_by_keys(spark, world, centers):
    made, frames = world
    mr, visit = {"m1", "m2", "m99"}, {"v3", "v4", "v5", "v99"}
    wanted = {"1", "2"} if centers == CENTERS else set() if centers == "9" else {"1", "2", "3"}
    patients = {p[0]: p for p in made["patient"]}
    expected = [
        (*r[:2], *r[3:], *patients.get(r[0], [None] * 10)[1:])
        for r in made["registration"]
        if r[2] in wanted and (r[0] in mr or r[1] in visit)
    ]
    got = staging.patients_by_keys(
        frames["registration"], frames["patient"], frames["center"], centers,
        spark.createDataFrame([(m,) for m in mr], "id string"), spark.createDataFrame([(v,) for v in visit], "id string"),
    )
    assert rows(got) == sorted(expected, key=repr)


def test_diagnoses_and_observations_by_keys(spark, world):
    made, frames = world
    visits = distinct_keys(frames["registration"].where("center_id = '1'"), "patient_id")
    ids = {r.patient_id for r in visits.collect()}
    expected = sorted((d for d in made["diagnosis"] if d[0] in ids), key=repr)
    assert rows(staging.diagnoses_by_keys(frames["diagnosis"], frames["center"], "1,2", visits)) == expected
    assert rows(staging.diagnoses_by_keys(frames["diagnosis"], frames["center"], "", visits)) == expected
    assert staging.diagnoses_by_keys(frames["diagnosis"], frames["center"], "77", visits).count() == 0
    charges = distinct_keys(frames["observation"].where("code < 'o2'"), "charge_id")
    kept = {r.charge_id for r in charges.collect()}
    assert rows(staging.observations_by_keys(frames["observation"], charges)) == sorted(
        (o for o in made["observation"] if o[0] in kept), key=repr
    )


def test_facts_with_known_center(spark, world):
    _, frames = world
    fact = spark.createDataFrame([("a", "1"), ("b", "8"), ("c", None)], "activityid string, center_id string")
    assert rows(staging.with_known_center(fact, frames["center"])) == [("a", "1")]
