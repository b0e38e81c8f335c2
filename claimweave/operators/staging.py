"""Staging joins: the rows of a submission period, or of a set of keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from claimweave.operators.filters import between_days, filter_centers
from claimweave.operators.keys import distinct_keys, keep_keys, key_join, one_per_key
from claimweave.operators.projections import PATIENT_PART, REGISTRATION_PART


def in_known_center(rows: DataFrame, center: DataFrame, centers: str | list | None) -> DataFrame:
    """Rows of the asked centers that exist in the center master."""
    wanted = filter_centers(rows, centers)
    known = filter_centers(center.select(F.col("center_id").cast("string").alias("known_center")), centers, "known_center")
    return keep_keys(wanted, "center_id", known)


def staged_visits(
    batch: DataFrame,
    claim_header: DataFrame,
    registration: DataFrame,
    center: DataFrame,
    centers: str | list | None,
    start: date | str,
    end: date | str,
) -> DataFrame:
    """Registrations claimed in batches of the period, one row per claim header."""
    batches = between_days(batch, "submission_date", start, end).select("submission_batch_id")
    claimed = key_join(claim_header, batches, {"submission_batch_id": "submission_batch_id"})
    claimed = claimed.select(F.col("patient_id").alias("claimed_visit"))
    visits = in_known_center(registration, center, centers)
    return key_join(visits, claimed, {"patient_id": "claimed_visit"})


def stage_registrations(visits: DataFrame) -> DataFrame:
    return visits.select(*REGISTRATION_PART)


def stage_patients(visits: DataFrame, patient: DataFrame) -> DataFrame:
    """One row per patient that has a staged visit."""
    staged = keep_keys(patient.select(*PATIENT_PART), "mr_no", distinct_keys(visits, "mr_no"))
    return one_per_key(staged, ["mr_no"])


def stage_diagnoses(visits: DataFrame, diagnosis: DataFrame) -> DataFrame:
    """Diagnoses of the staged visits, once per claim header of the visit."""
    claimed = visits.select(F.col("patient_id").alias("claimed_visit"))
    return key_join(diagnosis, claimed, {"visit_id": "claimed_visit"})


def stage_observations_by_bill(
    observation: DataFrame, bill_charge: DataFrame, bill: DataFrame, start: date | str, end: date | str
) -> DataFrame:
    """Observations of charges on bills finalised in the period, once per bill line."""
    final = between_days(bill, "finalized_date", start, end).select("bill_no")
    charges = key_join(bill_charge.select("charge_id", "bill_no"), final, {"bill_no": "bill_no"})
    billed = charges.groupBy(F.col("charge_id").alias("billed_charge")).agg(F.count("*").alias("bill_lines"))
    per_line = key_join(observation, billed, {"charge_id": "billed_charge"})
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("bill_lines")))
    return per_line.select(*observation.columns, copies.alias("bill_line")).drop("bill_line")


def patients_by_keys(
    registration: DataFrame,
    patient: DataFrame,
    center: DataFrame,
    centers: str | list | None,
    patient_ids: DataFrame,
    visit_ids: DataFrame,
) -> DataFrame:
    """Registrations of the given patients or the given visits, with patient attributes.

    The OR is two flags from two equi joins: a join on the disjunction would compare all pairs.
    """
    ids = patient_ids.select(F.col(patient_ids.columns[0]).alias("wanted_mr"), F.lit(True).alias("by_patient"))
    details = patient.select(F.col("mr_no").alias("p_mr"), *[c for c in PATIENT_PART if c != "mr_no"])
    by_mr = details.join(ids, F.col("p_mr") == F.col("wanted_mr"), "full").withColumn(
        "any_mr", F.coalesce("p_mr", "wanted_mr")
    )
    visits = visit_ids.select(F.col(visit_ids.columns[0]).alias("wanted_visit"), F.lit(True).alias("by_visit"))
    rows = in_known_center(registration, center, centers)
    rows = key_join(rows, visits, {"patient_id": "wanted_visit"}, "left")
    rows = key_join(rows, by_mr.drop("p_mr", "wanted_mr"), {"mr_no": "any_mr"}, "left")
    return rows.where(F.col("by_patient") | F.col("by_visit")).select(
        *REGISTRATION_PART, *[c for c in PATIENT_PART if c != "mr_no"]
    )


def diagnoses_by_keys(
    diagnosis: DataFrame, center: DataFrame, centers: str | list | None, visit_ids: DataFrame
) -> DataFrame:
    """Diagnoses of the given visits, provided one of the asked centers exists at all."""
    some_center = filter_centers(center, centers)
    visits = visit_ids.where(some_center.exists())
    return keep_keys(diagnosis, "visit_id", visits)


def observations_by_keys(observation: DataFrame, charge_ids: DataFrame) -> DataFrame:
    return keep_keys(observation, "charge_id", charge_ids)


def with_known_center(fact: DataFrame, center: DataFrame) -> DataFrame:
    """Facts whose center is in the master, compared as text, once per master row."""
    master = center.select(F.col("center_id").alias("master_center"))
    return key_join(fact, master, {"center_id": "master_center"})
