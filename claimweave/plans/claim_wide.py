"""The wide claim table: facts of a period with every attribute, by one extract of the facts and one lazy plan over it."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from claimweave.operators.filters import between_days, filter_centers, first_submissions
from claimweave.operators.homes import HOME, Homes, with_homes
from claimweave.operators.keys import one_per_key
from claimweave.operators.pivots import diag_pivot_typed, obs_pivot
from claimweave.operators.projections import RENAMED, project_claim_fact
from claimweave.operators.updates import (
    DIAG_ASSIGN,
    DOCTOR_COLUMNS,
    same_names,
    take_matched,
    update_center,
    update_insurer,
    update_observations,
    update_patient,
    update_plan,
    update_rate_plan,
    update_tpa,
    visit_doctor_attributes,
)
from claimweave.schemas import CLAIM_FACT, CLAIM_WIDE, conform
from claimweave.session import work_folder
from claimweave.sources.contracts import Source, checked, frame_of, is_unique


# The keys of the masters.
MASTER_KEYS: dict[str, tuple[str, ...]] = {
    "patient": ("mr_no",),
    "registration": ("patient_id",),
    "doctor": ("doctor_id",),
    "department": ("dept_id",),
    "center": ("center_id",),
    "insurance_company": ("insurance_co_id",),
    "organization": ("org_id",),
    "plan": ("plan_id",),
    "category": ("category_id",),
    "tpa": ("tpa_id",),
}


@dataclass(frozen=True)
class ClaimSources:
    """The frames an enrichment run reads. Masters may come as `Keyed`, which spares them an aggregate each."""

    patient: Source
    registration: Source
    diagnosis: DataFrame
    observation: DataFrame
    doctor: Source
    department: Source
    center: Source
    insurance_company: Source
    organization: Source
    plan: Source
    category: Source
    tpa: Source

    def with_unique_keys(self) -> ClaimSources:
        """The same sources after counting the masters' keys in one job; a repeated key is an error."""
        declared = {n: (frame_of(getattr(self, n)), list(keys)) for n, keys in MASTER_KEYS.items() if not is_unique(getattr(self, n), list(keys))}
        return replace(self, **checked(declared)) if declared else self


def select_claims(
    fact: DataFrame,
    start: date | str,
    end: date | str,
    centers: str | list | None = None,
    date_column: str = "submission_date",
) -> DataFrame:
    """First submissions of a period and a set of centers, in the wide layout."""
    chosen = filter_centers(between_days(first_submissions(fact), date_column, start, end), centers)
    return project_claim_fact(chosen)


def update_visit(claims: DataFrame, homes: Homes, doctor_attributes: Source, diag_pivot: DataFrame) -> DataFrame:
    """Doctor and diagnosis updates in one join.

    Both sources have one row per visit. The visits that the facts ask for meet both where they are, so no wide row of a visit is shuffled but
    the answer.
    """
    assign = {**same_names(DOCTOR_COLUMNS), **DIAG_ASSIGN}
    unique = is_unique(doctor_attributes, ["reg_visit_id"])
    one_each = frame_of(doctor_attributes) if unique else one_per_key(doctor_attributes, ["reg_visit_id"])
    doctors = one_each.select(
        "reg_visit_id",
        *[F.col(c).alias(f"new_{c}") for c in DOCTOR_COLUMNS],
        F.lit(True).alias("has_doctor"),
    )
    diagnoses = diag_pivot.select(
        "visit_id",
        *[F.col(slot).alias(f"new_{c}") for c, slot in DIAG_ASSIGN.items()],
        F.lit(True).alias("has_diagnosis"),
    )
    joined = homes.meet(claims, "visit_id", (doctors, "reg_visit_id"), (diagnoses, "visit_id"))
    hits = {c: "has_doctor" if c in DOCTOR_COLUMNS else "has_diagnosis" for c in assign}
    return take_matched(claims, joined, hits)


def enrich_claims(homes: Homes, src: ClaimSources, as_of: date | str | None = None) -> DataFrame:
    """All updates but the insurer's in one pass. They write disjoint columns, so their order is free.

    The facts are shuffled once, by home; sources that grow with the facts answer there. The masters that
    stay small whatever the number of facts (centers, organizations, administrators) follow; Spark broadcasts them.
    """
    # Attributes that are filled here are typed nulls above the shuffle.
    claims = conform(homes.dealt(), StructType([StructField(HOME, LongType()), *CLAIM_WIDE.fields]))
    claims = update_plan(claims, src.plan, src.category, homes.join)
    claims = update_patient(claims, src.patient, as_of, homes.join)
    claims = update_observations(claims, obs_pivot(src.observation), homes.join)
    doctors = visit_doctor_attributes(src.registration, src.doctor, src.department)
    claims = update_visit(claims, homes, doctors, diag_pivot_typed(src.diagnosis)).drop(HOME)
    claims = update_rate_plan(claims, src.organization)
    claims = update_tpa(claims, src.tpa)
    return update_center(claims, src.center)


def build_claim_wide(
    fact: DataFrame,
    src: ClaimSources,
    start: date | str,
    end: date | str,
    centers: str | list | None = None,
    as_of: date | str | None = None,
    date_column: str = "submission_date",
) -> DataFrame:
    """The claims are written to the work folder first, without the columns that nothing has filled yet: a job of its own, so that facts
    which are joins themselves are made once. Insurers are many for a master of few columns; they come while the facts are narrowest.
    """
    spark, have = fact.sparkSession, {c.lower() for c in fact.columns}
    claims = update_insurer(select_claims(fact, start, end, centers, date_column), src.insurance_company)
    filled = {"insurancecompany", *[RENAMED.get(f.name, f.name) for f in CLAIM_FACT.fields if f.name in have]}
    path = work_folder(spark, "extract")
    with_homes(claims.select(*[c for c in claims.columns if c in filled])).write.option("compression", "zstd").parquet(path)
    return enrich_claims(Homes(spark.read.parquet(path)), src, as_of)
