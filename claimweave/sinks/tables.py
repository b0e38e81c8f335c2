"""Table, export and upsert sinks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimweave.operators.filters import as_date, between_days, center_list, filter_centers
from claimweave.operators.projections import export_schema, registration_and_patient_rows
from claimweave.operators.sets import upsert
from claimweave.sinks.folders import beside, delete, exists, swap
from claimweave.sources.contracts import checked, mark_unique

EXPORT_CHUNK_ROWS = 50_000


def write_overwrite(df: DataFrame, path: str, skip_empty: bool = True, unique: list[str] | None = None) -> bool:
    """Replace a table; by default an empty frame leaves the old table as it is.

    The frame is written once, beside the table, and then takes its place. So the old table survives
    a failure, and the frame may itself read the table it replaces. Keys declared ``unique`` are counted on what
    was written; repeated ones are an error and leave the old table too.
    """
    spark, new = df.sparkSession, beside(path)
    rows = Observation("new_rows")
    try:
        df.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(new)
        if skip_empty and rows.get["n"] == 0:
            return False
        if unique:
            checked({path: (spark.read.schema(df.schema).parquet(new), unique)})
            mark_unique(spark, new, unique)
        swap(spark, new, path)
        return True
    finally:
        delete(spark, new)


def write_append(df: DataFrame, path: str) -> None:
    """Add rows; loading the same rows again repeats them."""
    df.write.mode("append").parquet(path)


def _months(start: date, end: date) -> list[str]:
    return [f"{m // 12}-{m % 12 + 1:02d}" for m in range(start.year * 12 + start.month - 1, end.year * 12 + end.month)]


def replace_claims(
    df: DataFrame,
    path: str,
    start: date | str,
    end: date | str,
    centers: str | list | None = None,
    date_column: str = "submission_date",
    center_column: str = "center_id",
) -> None:
    """Replace just what a run covers: its days and its centers (all of them if none are named).

    The table lies in folders by month. Of the months the run touches, rows of other days or centers are kept. Each
    month is written beside the table and then takes its place; a rerun repeats nothing. Rows of ``df`` outside the
    run, or without a day, are refused before anything is replaced.
    """
    spark, first, last = df.sparkSession, as_date(start), as_date(end)
    month = F.date_format(date_column, "yyyy-MM")
    ids = center_list(centers)
    day = F.to_date(date_column)
    inside = (day >= F.lit(first)) & (day <= F.lit(last))
    if ids:
        inside = inside & F.col(center_column).cast("string").isin(ids)
    inside = F.coalesce(inside, F.lit(False))
    outside = Observation("outside_the_run")
    frame = df.observe(outside, F.count(F.when(~inside, 1)).alias("n")).withColumn("submission_month", month)
    months = _months(first, last)
    if exists(spark, path):
        schema = StructType([*df.schema.fields, StructField("submission_month", StringType())])
        saved = spark.read.schema(schema).parquet(path).where(F.col("submission_month").isin(months))
        frame = frame.unionByName(saved.where(~inside).select(*frame.columns))
    new = beside(path)
    try:
        frame.write.partitionBy("submission_month").parquet(new)
        if outside.get["n"]:
            raise ValueError(f"{outside.get['n']} rows lie outside the run")
        for name in months:
            part = f"submission_month={name}"
            made = exists(spark, f"{new}/{part}")
            swap(spark, f"{new}/{part}" if made else None, f"{path.rstrip('/')}/{part}")
    finally:
        delete(spark, new)


def upsert_table(path: str, updates: DataFrame, keys: list[str], latest: str | None = None) -> None:
    target = updates.sparkSession.read.parquet(path)
    write_overwrite(upsert(target, updates, keys, latest), path)


def write_patient_extract(joined: DataFrame, folder: str) -> None:
    """Write one extracted frame as its registration and patient tables, computing it once.

    Both parts are written by one pass, side by side, and then made into the two tables; so nothing is held in executors, and
    a lost one costs no second run of the extract.
    """
    spark, root = joined.sparkSession, folder.rstrip("/")
    rows, both = registration_and_patient_rows(joined), beside(f"{root}/parts")
    try:
        rows.write.partitionBy("part").parquet(both)
        for part in ("registration", "patient"):
            own = StructType([rows.schema[part]])
            write_overwrite(spark.read.schema(own).parquet(f"{both}/part={part}").select(f"{part}.*") if exists(spark, f"{both}/part={part}") else rows.limit(0).select(f"{part}.*"), f"{root}/{part}")
    finally:
        delete(spark, both)


def seed_claims(staging: DataFrame) -> DataFrame:
    """Visit-grain variant: the wide table starts as the staged patients and visits."""
    return staging.select(F.col("patient_id").alias("patientid"), "visit_id")


def export_name(start: date | str, end: date | str, centers: str | list | None) -> str:
    ids = center_list(centers)
    suffix = f"center_{'_'.join(ids)}" if ids else "all_centers"
    return f"claim_data_{start}_to_{end}_{suffix}"


def export_csv(
    claims: DataFrame,
    folder: str,
    start: date | str,
    end: date | str,
    centers: str | list | None = None,
    date_column: str = "submission_date",
) -> str:
    """Claims of a period and centers as compressed CSV with a header; returns the export's path."""
    path = f"{folder.rstrip('/')}/{export_name(start, end, centers)}"
    chosen = filter_centers(between_days(claims, date_column, start, end), centers)
    chosen.write.mode("overwrite").option("header", True).option("escape", '"').option("compression", "gzip").csv(path)
    return path


def export_chunks(df: DataFrame, path: str, keys: list[str], rows: int = EXPORT_CHUNK_ROWS) -> None:
    """The whole table in key order, in export types, at most ``rows`` rows per file.

    File names ascend with the keys: partitions are key ranges, and each is sorted. A hash of the
    row breaks ties, so that rows of one frequent key can be cut into several ranges.
    """
    typed = export_schema(df)
    ordered = typed.withColumn("tie", F.xxhash64(*typed.columns)).repartitionByRange(*keys, "tie")
    ordered = ordered.sortWithinPartitions(*keys, "tie").drop("tie")
    ordered.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)
