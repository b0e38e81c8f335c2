"""Scalar column expressions of the claim product."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# The characters a Python str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def strip(c: Column) -> Column:
    """Text without leading and trailing whitespace of any kind (not only spaces)."""
    return F.btrim(c, F.lit(WHITESPACE))


def full_name(first: Column, middle: Column, last: Column) -> Column:
    """First, middle and last name; null when the first name is, as || would give."""
    mid = F.coalesce(middle, F.lit(""))
    gap = F.when(mid != "", F.lit(" ")).otherwise("")
    return F.concat(first, F.lit(" "), mid, gap, F.coalesce(last, F.lit("")))


def birth_date(expected: Column, recorded: Column) -> Column:
    return F.coalesce(expected, recorded)


def month_day_year(d: Column) -> Column:
    return F.date_format(d, "MMM-dd-yyyy")


def age_in_years(born: Column, as_of: date | str | None = None) -> Column:
    """Completed calendar years; months_between would be wrong at month ends."""
    on = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    before_birthday = F.month(on) * 100 + F.dayofmonth(on) < F.month(born) * 100 + F.dayofmonth(born)
    return (F.year(on) - F.year(born) - before_birthday.cast("int")).cast("int")


def date_plus_time(day: Column, time_text: Column) -> Column:
    return F.concat(day.cast("string"), F.lit(" "), time_text).try_cast("timestamp_ntz")


def slot_label(diag_type: Column, rank: Column) -> Column:
    return F.when(diag_type == "S", F.concat(diag_type, rank.cast("string"))).otherwise(diag_type)
