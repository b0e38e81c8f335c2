import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from claimweave.operators.projections import PATIENT_PART, REGISTRATION_PART
from claimweave.plans.runs import DimSpec, master_specs, refresh_dims
from claimweave.sinks import folders
from claimweave.sinks import tables as sinks
from claimweave.sources.tables import read_csv
from row_sets import rows


def test_empty_frame_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    assert sinks.write_overwrite(df, path)
    assert not sinks.write_overwrite(df.where("id < 0"), path)
    assert spark.read.parquet(path).count() == 3
    assert sinks.write_overwrite(df.where("id < 0"), path, skip_empty=False)
    assert spark.read.parquet(path).count() == 0


def test_table_may_be_replaced_by_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)
    sinks.write_overwrite(spark.read.parquet(path).where("id > 1"), path)
    assert rows(spark.read.parquet(path)) == [(2,), (3,)]


CLAIMS = "id int, center_id string, submission_date timestamp_ntz"


def three_claims(spark):
    return spark.createDataFrame([(1, "1", datetime(2024, 1, 5)), (2, "2", datetime(2024, 1, 6)), (3, "1", datetime(2024, 1, 20)), (4, "1", datetime(2024, 2, 5))], CLAIMS)


def test_append_repeats_rows(spark, tmp_path):
    for _ in range(2):
        sinks.write_append(three_claims(spark), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 8


def test_a_run_replaces_its_days_and_centers_only(spark, tmp_path):
    path = str(tmp_path / "t")
    df = three_claims(spark)
    for _ in range(2):
        sinks.replace_claims(df, path, "2024-01-01", "2024-02-29")
    assert rows(spark.read.parquet(path).select("id")) == [(1,), (2,), (3,), (4,)]
    half = df.where("id = 3").withColumn("id", F.lit(30))
    for _ in range(2):
        sinks.replace_claims(half, path, "2024-01-15", "2024-01-31", "1")
    assert set(rows(spark.read.parquet(path).select("id"))) == {(1,), (2,), (4,), (30,)}
    sinks.replace_claims(df.where("false"), path, "2024-01-01", "2024-01-10", ["2"])
    assert set(rows(spark.read.parquet(path).select("id"))) == {(1,), (4,), (30,)}
    sinks.replace_claims(df.where("false"), path, "2024-02-01", "2024-02-29")
    assert rows(spark.read.parquet(path).select("id")) == [(1,), (30,)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_rows_outside_the_run_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    df = three_claims(spark)
    sinks.replace_claims(df, path, "2024-01-01", "2024-02-29")
    for start, centers in (("2024-01-06", None), ("2024-01-01", "1")):
        with pytest.raises(ValueError, match="outside the run"):
            sinks.replace_claims(df, path, start, "2024-02-29", centers)
    with pytest.raises(ValueError):
        sinks.replace_claims(df.withColumn("submission_date", F.lit(None).cast("timestamp_ntz")), path, "2024-01-01", "2024-02-29")
    assert spark.read.parquet(path).count() == 4


def test_a_failed_step_keeps_the_old_table_and_no_copies_stay(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in (3, 4):
        sinks.write_overwrite(spark.range(n), path)
    assert spark.read.parquet(path).count() == 4

    def broken(spark, new, path):
        raise OSError("no rename")

    monkeypatch.setattr(sinks, "swap", broken)
    with pytest.raises(OSError):
        sinks.write_overwrite(spark.range(9), path)
    with pytest.raises(Exception):
        sinks.write_overwrite(spark.range(9).select(F.raise_error(F.lit("bad"))), path)
    assert spark.read.parquet(path).count() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_failed_second_rename_puts_the_old_folder_back(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(Exception, match="missing"):
        folders.swap(spark, str(tmp_path / "missing"), path)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_upsert_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int").write.parquet(path)
    for _ in range(2):
        sinks.upsert_table(path, spark.createDataFrame([("b", 2), ("c", 3)], "k string, v int"), ["k"])
    assert rows(spark.read.parquet(path)) == [("a", 1), ("b", 2), ("c", 3)]


def test_csv_export(spark, tmp_path):
    schema = "claimid string, center_id string, submission_date timestamp_ntz, note string"
    df = spark.createDataFrame(
        [("1", "7", datetime(2024, 1, 31, 23, 59), 'say "hi", twice'), ("2", "8", datetime(2024, 1, 2), "x"), ("3", "7", datetime(2024, 2, 1), "x")],
        schema,
    )
    path = sinks.export_csv(df, str(tmp_path), "2024-01-01", "2024-01-31", "7")
    assert path.endswith("claim_data_2024-01-01_to_2024-01-31_center_7")
    assert rows(read_csv(spark, path, df.schema)) == rows(df.where("claimid = '1'"))
    parts = list((tmp_path / path.rsplit("/", 1)[-1]).glob("*.csv.gz"))
    assert gzip.open(parts[0], "rt").readline().strip() == "claimid,center_id,submission_date,note"
    assert sinks.export_name("a", "b", "") == "claim_data_a_to_b_all_centers"


def test_chunked_export_is_ordered_and_whole(spark, tmp_path):
    path = str(tmp_path / "x")
    sinks.export_chunks(spark.range(1000).orderBy(F.rand(1)), path, ["id"], rows=64)
    seen = []
    for part in sorted((tmp_path / "x").glob("part-*")):
        ids = [r.id for r in spark.read.parquet(str(part)).collect()]
        assert len(ids) <= 64
        seen += ids
    assert seen == list(range(1000))


def test_refresh_dims(spark, tmp_path):
    source = spark.createDataFrame([("1", "Eye", "x")], "dept_id string, dept_name string, status string")
    specs = [DimSpec("department", source, ("dept_id", "dept_name")), DimSpec("whole", source)]
    assert refresh_dims(specs, str(tmp_path)) == {"department": True, "whole": True}
    assert rows(spark.read.parquet(str(tmp_path / "department"))) == [("1", "Eye")]
    assert spark.read.parquet(str(tmp_path / "whole")).columns == ["dept_id", "dept_name", "status"]


def test_master_specs(spark, tmp_path):
    doctors = spark.createDataFrame([("d", "A", "1", "extra")], "doctor_id string, doctor_name string, dept_id string, mail string")
    tpa = spark.createDataFrame([("t", "T", "x")], "tpa_id string, tpa_name string, city string")
    refresh_dims(master_specs({"doctor": doctors, "tpa": tpa}), str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "doctor")).columns == ["doctor_id", "doctor_name", "dept_id"]
    assert spark.read.parquet(str(tmp_path / "tpa")).columns == tpa.columns
    assert master_specs({"doctor": doctors}, whole=True)[0].frame().columns == doctors.columns


def test_patient_extract(spark, tmp_path):
    row = {c: f"{c}-1" for c in REGISTRATION_PART + PATIENT_PART}
    joined = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    sinks.write_patient_extract(joined, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "registration")).columns == REGISTRATION_PART
    assert spark.read.parquet(str(tmp_path / "patient")).first().mr_no == "mr_no-1"
