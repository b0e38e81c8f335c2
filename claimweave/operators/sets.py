"""Set operations, counts, paging and upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from claimweave.schemas import OPEN_CLAIM, conform, contract

CLAIM_UNION = contract(
    "claimid string, insurancecompany string, tpa_name string, patientid string, patientname string, "
    "patientbirthdate string, encounterdiagnosisprincipal string, visit_id string, insurance_co_id string, "
    "admitting_dr_id string, doctorname string, tpa_id string, center_id string, plan_id string, "
    "registration_date timestamp_ntz, centername string, insurance_plan string"
)


def claims_union(submitted: DataFrame, open_claims: DataFrame) -> DataFrame:
    """Submitted and open claims, each side without duplicates, in one layout."""
    sent = conform(submitted.withColumnsRenamed({"primary_icd": "encounterdiagnosisprincipal"}), CLAIM_UNION)
    pending = conform(open_claims, OPEN_CLAIM).withColumnsRenamed({"claim_id": "claimid", "patient_id": "patientid"})
    return sent.distinct().unionByName(conform(pending, CLAIM_UNION).distinct())


def row_count(df: DataFrame, alias: str = "record_count") -> DataFrame:
    return df.agg(F.count("*").alias(alias))


def load_audit(df: DataFrame, table_name: str) -> DataFrame:
    return df.agg(F.count("*").alias("record_count")).select(F.lit(table_name).alias("table_name"), "record_count")


def distinct_key_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null values per key column, in one pass over the frame."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("key_column"), F.col(c).cast("string").alias("key")) for c in columns])
    )
    keys = df.select(pairs.alias("pair")).select("pair.*").distinct()
    return keys.groupBy("key_column").agg(F.count("key").alias("id_count"))


def page(df: DataFrame, keys: list[str], size: int, offset: int = 0) -> DataFrame:
    """One ordered page. Meant for early pages: every page sorts out offset + size rows."""
    return df.orderBy(*keys).offset(offset).limit(size)


def page_after(df: DataFrame, keys: list[str], size: int, last: list | None = None) -> DataFrame:
    """The page behind the given (leading) key values; costs the same however deep it is."""
    if last is not None:
        steps = []
        for i, (key, value) in enumerate(zip(keys, last)):
            same = [F.col(k) == F.lit(v) for k, v in zip(keys[:i], last[:i])]
            steps.append(reduce(lambda a, b: a & b, same, F.col(key) > F.lit(value)))
        df = df.where(reduce(lambda a, b: a | b, steps))
    return df.orderBy(*keys).limit(size)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], latest: str | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE; the target's keys are unique, as the conflict clause asks.

    Rows of the batch that share a key are reduced to the one with the greatest ``latest``, then the greatest values. A null key
    conflicts with nothing: such rows are all kept and inserted. Columns that the batch doesn't have keep their values, and are null in
    inserted rows. Each side is read once: the reduced batch meets the target in
    a full outer join, in which rows with a null key are spread by a hash of the row.
    """
    rest = [c for c in updates.columns if c not in keys]
    order = ([latest] if latest else []) + [c for c in rest if c != latest]
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    # Rows without a key are groups of their own.
    alone = F.when(no_key, F.monotonically_increasing_id() + 1).otherwise(F.lit(0))
    best = F.max_by(F.struct(*rest), F.struct(*order)) if rest else F.count("*")
    grouped = updates.withColumn("_alone", alone).groupBy(*keys, "_alone").agg(best.alias("best"))
    batch = grouped.select(F.struct(*keys, *(["best.*"] if rest else [])).alias("new"), "_alone")

    def keyed(df: DataFrame, values: str, spread: Column, side: str) -> DataFrame:
        own = [F.col(f"{values}.{k}").cast("string") for k in keys]
        null = reduce(lambda a, b: a | b, [k.isNull() for k in own])
        place = F.when(null, spread).otherwise(F.xxhash64(*own)).alias(f"_{side}_hash")
        return df.select(values, place, *[k.alias(f"_{side}_{i}") for i, k in enumerate(own)])

    old = keyed(target.select(F.struct("*").alias("old")), "old", F.xxhash64("old"), "old")
    new = keyed(batch, "new", F.xxhash64("_alone"), "new")
    matched = [F.col(f"_old_{i}") == F.col(f"_new_{i}") for i in range(len(keys))]
    both = old.join(new, reduce(lambda a, b: a & b, matched, F.col("_old_hash") == F.col("_new_hash")), "full")
    taken = {c: F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")) for c in updates.columns}
    return both.select(*[taken.get(c, F.col(f"old.{c}")).alias(c) for c in target.columns])
