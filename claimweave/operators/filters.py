"""Row filters."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType


def as_date(d: date | str) -> date:
    return d if isinstance(d, date) else date.fromisoformat(str(d).strip())


def day_range(column: Column, start: date | str, end: date | str) -> Column:
    """Whole days, both ends included. The column stays bare so that scans can use the range."""
    first = F.lit(as_date(start))
    after = F.lit(as_date(end) + timedelta(days=1))
    return (column >= first) & (column < after)


def between_days(df: DataFrame, column: str, start: date | str, end: date | str) -> DataFrame:
    c = F.col(column)
    if isinstance(df.schema[column].dataType, StringType):
        c = c.try_cast("timestamp_ntz")
    return df.where(day_range(c, start, end))


def center_list(centers: str | list | None) -> list[str]:
    if centers is None:
        return []
    items = centers.split(",") if isinstance(centers, str) else centers
    return [str(i).strip() for i in items if str(i).strip()]


def filter_centers(df: DataFrame, centers: str | list | None, column: str = "center_id") -> DataFrame:
    """Rows of the given centers; a blank list means all centers."""
    ids = center_list(centers)
    return df.where(F.col(column).cast("string").isin(ids)) if ids else df


def first_submissions(df: DataFrame) -> DataFrame:
    return df.where(F.col("org_sub_seq") == 1)


def with_level(entries: DataFrame, level: str) -> DataFrame:
    """Log entries of one level, in whatever case it was written."""
    return entries.where(F.lower("log_level") == level.lower())
