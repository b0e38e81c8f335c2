"""UPDATE ... FROM as a left join, and the enrichment updates built on it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, functions as F

from claimweave.functions import scalars
from claimweave.operators.keys import key_join, one_per_key
from claimweave.schemas import (
    DIAG_COLUMNS,
    DIAG_SLOTS,
    OBS_ATTRIBUTES,
    OBSERVATION_SLOTS,
)
from claimweave.sources.contracts import Keyed, Source, frame_of, is_unique

#: How facts meet a source: `key_join`, or `Homes.join` for facts that are dealt to homes.
Join = Callable[[DataFrame, DataFrame, dict[str, str], str], DataFrame]


def take_matched(target: DataFrame, joined: DataFrame, hits: dict[str, str]) -> DataFrame:
    """Target columns after an update.

    ``hits`` maps a column to its match flag; its new value is in ``new_<column>``. A matched
    row takes the new value even when that is null, an unmatched row keeps what it has.
    """
    types = {f.name: f.dataType.simpleString() for f in target.schema.fields}

    def updated(name: str) -> str:
        new = f"CAST(`new_{name}` AS {types[name]})" if name in types else f"`new_{name}`"
        old = f" ELSE `{name}`" if name in types else ""
        return f"CASE WHEN {hits[name]} THEN {new}{old} END AS `{name}`"

    kept = [updated(c) if c in hits else f"`{c}`" for c in types]
    added = [updated(c) for c in hits if c not in types]
    return joined.selectExpr(*kept, *added)


def update_from(
    target: DataFrame,
    source: Source,
    on: dict[str, str],
    assign: dict[str, str],
    order_by: list[str] | None = None,
    unique: bool = False,
    join: Join = key_join,
) -> DataFrame:
    """UPDATE target SET a = source.b ... FROM source WHERE target.k = source.k.

    ``on`` maps target keys to source keys, ``assign`` target columns to source columns.
    If several source rows share a key, the first one under ``order_by`` (then by value)
    is taken, which costs a sorted aggregate of the source. Sources whose key was counted (``Keyed``) go without;
    pass ``unique=True`` for sources that have one row per key by construction.
    """
    keys = list(on.values())
    unique, source = unique or is_unique(source, keys), frame_of(source)
    needed = keys + [c for c in dict.fromkeys([*assign.values(), *(order_by or [])]) if c not in keys]
    picked = source.select(*needed)
    if not unique:
        picked = one_per_key(picked, keys, order_by)
    new = picked.select(
        *[F.col(k).alias(f"key_{k}") for k in keys],
        *[F.col(s).alias(f"new_{t}") for t, s in assign.items()],
        F.lit(True).alias("was_hit"),
    )
    joined = join(target, new, {t: f"key_{s}" for t, s in on.items()}, "left")
    return take_matched(target, joined, {t: "was_hit" for t in assign})


def patient_attributes(patient: Source, as_of: date | str | None = None) -> Source:
    born = scalars.birth_date(F.col("expected_dob"), F.col("dateofbirth"))
    attributes = frame_of(patient).select(
        "mr_no",
        scalars.full_name(F.col("patient_name"), F.col("middle_name"), F.col("last_name")).alias("patientname"),
        scalars.month_day_year(born).alias("patientbirthdate"),
        scalars.age_in_years(born, as_of).alias("age"),
        F.col("patient_gender").alias("gender"),
        F.col("custom_list1_value").alias("nationality"),
        F.col("custom_field2").alias("passport_no"),
    )
    return patient.with_frame(attributes) if is_unique(patient, ["mr_no"]) else attributes


PATIENT_COLUMNS = ["patientname", "patientbirthdate", "age", "gender", "nationality", "passport_no"]
DOCTOR_COLUMNS = [
    "doctorname",
    "doctorsdepartment",
    "encountertransfersource",
    "encountertransferdestination",
    "registration_date",
]


def visit_doctor_attributes(registration: Source, doctor: Source, department: Source) -> Source:
    """Doctor, department and transfer attributes of a visit; no row unless both lookups succeed.

    One row per visit if all three sources are unique by their keys.
    """
    unique = is_unique(registration, ["patient_id"]) and is_unique(doctor, ["doctor_id"]) and is_unique(department, ["dept_id"])
    staff = key_join(
        frame_of(doctor).select("doctor_id", "doctor_name", "dept_id"),
        frame_of(department).select(F.col("dept_id").alias("d_id"), F.col("dept_name").alias("doctor_dept")),
        {"dept_id": "d_id"},
    ).drop("dept_id")
    visits = frame_of(registration).select(
        "patient_id", "doctor", "reg_date", "reg_time", "transfer_source", "transfer_destination"
    )
    attributes = key_join(visits, staff, {"doctor": "doctor_id"}).select(
        F.col("patient_id").alias("reg_visit_id"),
        F.col("doctor_name").alias("doctorname"),
        F.col("doctor_dept").alias("doctorsdepartment"),
        F.col("transfer_source").alias("encountertransfersource"),
        F.col("transfer_destination").alias("encountertransferdestination"),
        scalars.date_plus_time(F.col("reg_date"), F.col("reg_time")).alias("registration_date"),
    )
    return Keyed(attributes, ("reg_visit_id",)) if unique else attributes


def plan_attributes(plan: Source, category: Source) -> Source:
    """Plan name and category name; a plan without a known category does not update. One row per plan if both sources are unique."""
    attributes = key_join(
        frame_of(plan).select("plan_id", "plan_name", "category_id"),
        frame_of(category).select(F.col("category_id").alias("cat_id"), "category_name"),
        {"category_id": "cat_id"},
    ).select("plan_id", F.col("plan_name").alias("insurance_plan"), F.col("category_name").alias("insurance_plan_type"))
    return Keyed(attributes, ("plan_id",)) if is_unique(plan, ["plan_id"]) and is_unique(category, ["category_id"]) else attributes


def same_names(columns: list[str]) -> dict[str, str]:
    return {c: c for c in columns}


DIAG_ASSIGN = dict(zip(DIAG_COLUMNS, DIAG_SLOTS))
OBS_ASSIGN = {
    f"{wide}{i}": f"{prefix}{i}"
    for i in range(1, OBSERVATION_SLOTS + 1)
    for prefix, (_, wide) in OBS_ATTRIBUTES.items()
}


def update_patient(claims: DataFrame, patient: Source, as_of: date | str | None = None, join: Join = key_join) -> DataFrame:
    attributes = patient_attributes(patient, as_of)
    return update_from(claims, attributes, {"patientid": "mr_no"}, same_names(PATIENT_COLUMNS), join=join)


def update_insurer(claims: DataFrame, company: Source) -> DataFrame:
    on = {"insurance_co_id": "insurance_co_id"}
    return update_from(claims, company, on, {"insurancecompany": "insurance_co_name"})


def update_rate_plan(claims: DataFrame, organization: Source) -> DataFrame:
    return update_from(claims, organization, {"rate_plan_id": "org_id"}, {"rate_plan": "org_name"})


def update_plan(claims: DataFrame, plan: Source, category: Source, join: Join = key_join) -> DataFrame:
    attributes = plan_attributes(plan, category)
    return update_from(
        claims, attributes, {"plan_id": "plan_id"}, same_names(["insurance_plan", "insurance_plan_type"]), join=join
    )


def update_tpa(claims: DataFrame, tpa: Source) -> DataFrame:
    return update_from(claims, tpa, {"tpa_id": "tpa_id"}, {"tpa_name": "tpa_name"})


def update_center(claims: DataFrame, center: Source) -> DataFrame:
    return update_from(claims, center, {"center_id": "center_id"}, {"centername": "center_name"})


def update_doctor(
    claims: DataFrame, registration: Source, doctor: Source, department: Source
) -> DataFrame:
    attributes = visit_doctor_attributes(registration, doctor, department)
    return update_from(claims, attributes, {"visit_id": "reg_visit_id"}, same_names(DOCTOR_COLUMNS))


def update_diagnosis(claims: DataFrame, diag_pivot: DataFrame) -> DataFrame:
    return update_from(claims, diag_pivot, {"visit_id": "visit_id"}, DIAG_ASSIGN, unique=True)


def update_observations(claims: DataFrame, obs_pivot: DataFrame, join: Join = key_join) -> DataFrame:
    return update_from(claims, obs_pivot, {"charge_id": "charge_id"}, OBS_ASSIGN, unique=True, join=join)


def update_visit_observation(claims: DataFrame, observations_pivot: DataFrame) -> DataFrame:
    """Visit-grain variant: the one observation value kept for the visit."""
    assign = {"observation_details": "observation_value"}
    return update_from(claims, observations_pivot, {"visit_id": "visit_id"}, assign)


def update_visit_insurance(claims: DataFrame, insurance_details: DataFrame) -> DataFrame:
    """Visit-grain variant: insurer and plan recorded for the visit."""
    assign = {"insurance_company": "company_name", "insurance_plan": "plan_name"}
    return update_from(claims, insurance_details, {"visit_id": "visit_id"}, assign)
