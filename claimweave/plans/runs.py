"""One job for all parameter rows, and the refresh of the masters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from claimweave.operators.filters import first_submissions
from claimweave.operators.intervals import day_range, level_of, period_ranges
from claimweave.sinks.tables import write_overwrite


def facts_per_param(fact: DataFrame, params: DataFrame, date_column: str = "submission_date") -> DataFrame:
    """Every fact once per parameter row whose period and centers it falls in, tagged with param_id.

    An equi join on (day range, center). A period is a few day ranges of lengths that are powers of two, once per center of its list;
    a row without a list, which means every center, has an empty center in its place. A day and center of the facts has one range per
    level, with its own center and with the empty one; of these only the kinds that parameter rows use. Facts then meet
    the runs of their day and center.
    """
    asked = F.array_distinct(F.filter(F.transform(F.split(F.coalesce("centers", F.lit("")), ","), lambda c: F.trim(c)), lambda c: c != ""))
    valid = params.where(F.col("from_date") <= F.col("to_date"))
    centers = F.when(F.size("asked") > 0, F.col("asked")).otherwise(F.array(F.lit("")))
    wanted = (
        valid.withColumn("asked", asked)
        .select("param_id", centers.alias("centers"), F.explode(period_ranges(F.col("from_date"), F.col("to_date"))).alias("run_range"))
        .select("param_id", "run_range", F.explode("centers").alias("run_center"))
    )
    # What parameter rows use, as scalar subqueries: scans can skip days outside, facts make no other keys.
    first = valid.agg(F.min("from_date")).scalar()
    after = valid.agg(F.date_add(F.max("to_date"), 1)).scalar()

    kinds = wanted.agg(F.collect_set(F.struct(level_of(F.col("run_range")).alias("level"), (F.col("run_center") == "").alias("every")))).scalar()
    inside = fact.where((F.col(date_column) >= first) & (F.col(date_column) < after))
    dated = inside.withColumns({"_day": F.to_date(date_column), "_center": F.coalesce(F.col("center_id").cast("string"), F.lit(""))})
    # The facts' days and centers, not the facts, meet the ranges; what comes of it has no more rows than the result.
    places = dated.select("_day", "_center").distinct().select("_day", "_center", F.explode(kinds).alias("_kind"))
    center = F.when(F.col("_kind.every"), "").otherwise(F.nullif(F.col("_center"), F.lit("")))
    keyed = places.select(F.col("_day").alias("run_day"), F.col("_center").alias("place"), day_range(F.col("_day"), F.col("_kind.level")).alias("_range"), center.alias("_asked"))
    runs = keyed.join(wanted, (F.col("_range") == F.col("run_range")) & (F.col("_asked") == F.col("run_center"))).select("run_day", "place", "param_id")
    joined = dated.join(runs, (F.col("_day") == F.col("run_day")) & (F.col("_center") == F.col("place")))
    return joined.select("param_id", *[F.col(c) for c in fact.columns])


def run_for_params(
    fact: DataFrame, params: DataFrame, job: Callable[[DataFrame], DataFrame] = lambda facts: facts
) -> DataFrame:
    """The pipeline over the first submissions of all parameter rows, as one distributed job.

    ``job`` sees the facts with their param_id and must carry it along.
    """
    return job(facts_per_param(first_submissions(fact), params))


@dataclass(frozen=True)
class DimSpec:
    """A master table to copy: where it is read from, its columns, the target name and the key it declares to be unique."""

    name: str
    source: DataFrame
    columns: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()

    def frame(self) -> DataFrame:
        return self.source.select(*self.columns) if self.columns else self.source


# The masters, and the columns kept of those that are not copied whole.
MASTERS: dict[str, tuple[str, ...]] = {
    "department": ("dept_id", "dept_name"),
    "doctor": ("doctor_id", "doctor_name", "dept_id"),
    "hospital_center": (),
    "insurance_category": (),
    "insurance_company": ("insurance_co_id", "insurance_co_name"),
    "insurance_plan": (),
    "organization": (),
    "tpa": (),
}


# The masters' keys, each the first column of its table.
MASTER_KEYS: dict[str, str] = {
    "department": "dept_id",
    "doctor": "doctor_id",
    "hospital_center": "center_id",
    "insurance_category": "category_id",
    "insurance_company": "insurance_co_id",
    "insurance_plan": "plan_id",
    "organization": "org_id",
    "tpa": "tpa_id",
}


def master_specs(sources: dict[str, DataFrame], whole: bool = False) -> list[DimSpec]:
    """Copies of the given masters with the columns the enrichment needs, or with all of them. Their keys are declared unique."""
    return [DimSpec(name, df, () if whole else MASTERS[name], (MASTER_KEYS[name],)) for name, df in sources.items()]


def refresh_dims(specs: list[DimSpec], target: str) -> dict[str, bool]:
    """Full copies of the masters; an empty source leaves the old copy in place.

    A declared key is counted on the new copy, before it takes the old one's place: a copy that repeats a key is refused. Reading
    the copies with `read_keyed` gives them as unique, without counting again.
    """
    return {s.name: write_overwrite(s.frame(), f"{target.rstrip('/')}/{s.name}", unique=list(s.unique)) for s in specs}
