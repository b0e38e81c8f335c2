from datetime import date, datetime

from pyspark.sql import functions as F

from claimweave.functions import scalars
from claimweave.operators.updates import patient_attributes
from claimweave.schemas import PATIENT


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_full_name(spark):
    cases = [
        (("John", None, "Doe"), "John Doe"),
        (("John", "", "Doe"), "John Doe"),
        (("John", "M", "Doe"), "John M Doe"),
        (("John", "M", None), "John M "),
        ((None, "M", "Doe"), None),
    ]
    for parts, expected in cases:
        literals = [F.lit(p).cast("string") for p in parts]
        assert one(spark, scalars.full_name(*literals))[0] == expected


def test_age_counts_completed_years_at_month_ends(spark):
    born = F.lit("2000-02-29").cast("date")
    assert one(spark, scalars.age_in_years(born, "2001-02-28"))[0] == 0
    assert one(spark, scalars.age_in_years(born, "2001-03-01"))[0] == 1
    assert one(spark, scalars.age_in_years(born, date(2020, 2, 29)))[0] == 20
    assert one(spark, scalars.age_in_years(F.lit(None).cast("date"), "2001-03-01"))[0] is None
    assert one(spark, scalars.age_in_years(born))[0] >= 25


def test_expected_birth_date_wins(spark):
    row = ("1", "Ann", None, None, date(1990, 1, 5), date(1991, 2, 6), "F", "X", "P1", "C2")
    got = patient_attributes(spark.createDataFrame([row], PATIENT), "2025-03-01").first()
    assert (got.patientbirthdate, got.age, got.passport_no) == ("Feb-06-1991", 34, "C2")


def test_date_plus_time_and_slot_label(spark):
    day = F.lit("2025-03-30").cast("date")
    assert one(spark, scalars.date_plus_time(day, F.lit("02:30:05")))[0] == datetime(2025, 3, 30, 2, 30, 5)
    assert one(spark, scalars.date_plus_time(day, F.lit(None).cast("string")))[0] is None
    assert one(spark, scalars.slot_label(F.lit("S"), F.lit(3)))[0] == "S3"
    assert one(spark, scalars.slot_label(F.lit("P"), F.lit(3)))[0] == "P"


def test_strip_removes_what_python_strips(spark):
    every_space = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
    text = every_space + "a \t b" + every_space
    assert one(spark, scalars.strip(F.lit(text)))[0] == text.strip() == "a \t b"
