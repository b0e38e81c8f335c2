"""Table, CSV and query sources."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from claimweave.operators.filters import as_date


@dataclass(frozen=True)
class JdbcSource:
    """Connection of a relational source; values come from the caller, never from this library."""

    url: str
    properties: dict[str, str]
    fetch_size: int = 100_000

    def options(self) -> dict[str, str]:
        return {"fetchsize": str(self.fetch_size), **self.properties}


def read_table(spark: SparkSession, source: str | JdbcSource, name: str) -> DataFrame:
    """A table, or for a relational source also a sub-query, by name.

    A string source is a folder of parquet tables.
    """
    if isinstance(source, JdbcSource):
        relation = f"({name}) as src" if " " in name.strip() else name
        return spark.read.jdbc(source.url, relation, properties=source.options())
    return spark.read.parquet(f"{source.rstrip('/')}/{name}.parquet")


def slice_predicates(number_expr: str, n: int) -> list[str]:
    """n SQL predicates that put every row into exactly one slice.

    They depend on the row alone, so n independent scans can neither lose nor repeat a row. Numbers go by their whole part; what has
    no residue (null, not a number) goes to slice 0. For text keys, pass the source's own hash of the key.
    """
    residue = f"abs(mod(floor({number_expr}), {n}))"
    rest = f"({residue}) IS NULL OR NOT ({residue} >= 1 AND {residue} <= {n - 1})"
    return [rest] + [f"{residue} = {i}" for i in range(1, n)]


def sql_literal(value) -> str:
    """A key value as standard SQL text."""
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def bounds_query(relation: str, keys: list[str], n: int) -> str:
    """SQL for the first key of each of n equally filled ranges but the first, over all keys of a relation or a sample of them.

    Any ordered keys will do: text, decimals, times. Several keys are compared one after the other, so that
    a frequent value of the first is cut by the next.
    """
    names = ", ".join(keys)
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    tiled = f"SELECT {names}, ntile({n}) OVER (ORDER BY {names}) AS tile FROM {relation} WHERE {known}"
    numbered = f"SELECT {names}, tile, row_number() OVER (PARTITION BY tile ORDER BY {names}) AS place FROM ({tiled}) AS t"
    return f"SELECT {names} FROM ({numbered}) AS p WHERE place = 1 AND tile > 1 ORDER BY {names}"


def range_predicates(keys: list[str], bounds: list[tuple]) -> list[str]:
    """SQL predicates of the ranges between sorted bounds, half open: every row is in exactly one, rows with a null key in the first."""
    bounds = list(dict.fromkeys(bounds))
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    unknown = " OR ".join(f"{k} IS NULL" for k in keys)

    def compared(bound: tuple, strict: str, last: str) -> str:
        """Keys before (or behind) a bound, key by key."""
        cases = []
        for i, key in enumerate(keys):
            same = [f"{k} = {sql_literal(v)}" for k, v in zip(keys[:i], bound[:i], strict=True)]
            cases.append(" AND ".join([*same, f"{key} {last if i == len(keys) - 1 else strict} {sql_literal(bound[i])}"]))
        return "(" + " OR ".join(f"({c})" for c in cases) + ")"

    out = []
    for low, high in zip([None, *bounds], [*bounds, None], strict=True):
        ends = ([compared(low, ">", ">=")] if low else []) + ([compared(high, "<", "<")] if high else [])
        inside = " AND ".join([known, *ends])
        out.append(f"({inside})" if low else f"({inside}) OR {unknown}")
    return out


def read_ranges(spark: SparkSession, source: str | JdbcSource, name: str, keys: list[str], n: int, sample: str = "") -> DataFrame:
    """Parallel scan of a relational table in n ranges of any ordered keys; parquet is split by Spark itself.

    One query finds the bounds, n - 1 rows; ``sample`` is the source's own clause for a sample (``TABLESAMPLE BERNOULLI (1)``), which makes that
    query cheap and the ranges about even. The ranges cover every row exactly once in any case.
    """
    if not isinstance(source, JdbcSource):
        return read_table(spark, source, name)
    relation = f"({name}) as src" if " " in name.strip() else name
    sampled = f"{relation} {sample}".strip()
    found = spark.read.jdbc(source.url, f"({bounds_query(sampled, keys, n)}) as bounds", properties=source.options())
    bounds = [tuple(r) for r in found.collect()]
    return spark.read.jdbc(source.url, relation, predicates=range_predicates(keys, bounds), properties=source.options())


def read_partitioned(
    spark: SparkSession, source: str | JdbcSource, name: str, number_expr: str, n: int
) -> DataFrame:
    """Parallel scan of a relational table in n slices; parquet is split by Spark itself."""
    if not isinstance(source, JdbcSource):
        return read_table(spark, source, name)
    relation = f"({name}) as src" if " " in name.strip() else name
    return spark.read.jdbc(
        source.url, relation, predicates=slice_predicates(number_expr, n), properties=source.options()
    )


def _chunk_days(start: date, end: date, n: int) -> int:
    return max(1, ((end - start).days + 1) // n)


def chunk_of_day(column: Column, start: date | str, end: date | str, n: int) -> Column:
    """Number 0..n-1 of the chunk a day falls in, null for days outside; the last chunk takes the remainder."""
    first, last = as_date(start), as_date(end)
    day = F.to_date(column)
    step = F.floor(F.datediff(day, F.lit(first)) / _chunk_days(first, last, n))
    return F.when((day >= F.lit(first)) & (day <= F.lit(last)), F.least(F.lit(n - 1), step)).cast("int")


def date_chunks(start: date | str, end: date | str, n: int) -> list[tuple[date, date]]:
    """The chunks' first and last days; fewer than n when there are fewer days."""
    first, last = as_date(start), as_date(end)
    days = _chunk_days(first, last, n)
    starts = [first + timedelta(days=i * days) for i in range(n) if first + timedelta(days=i * days) <= last]
    ends = [s - timedelta(days=1) for s in starts[1:]] + [last]
    return list(zip(starts, ends))


def chunk_predicates(column: str, start: date | str, end: date | str, n: int) -> list[str]:
    """One SQL predicate per date chunk, for a parallel relational scan."""
    return [
        f"{column} >= DATE '{a}' AND {column} < DATE '{b + timedelta(days=1)}'" for a, b in date_chunks(start, end, n)
    ]


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line, comma separated, double-quoted, in UTF-8."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )


def run_params(params_file: DataFrame) -> DataFrame:
    """Run parameters (param_id, centers, from_date, to_date) from the parameter file's text columns."""

    def unquoted(name: str) -> Column:
        return F.btrim(F.regexp_replace(name, "'", ""))

    return params_file.select(
        F.xxhash64("CenterID", "FromDate", "ToDate").alias("param_id"),
        unquoted("CenterID").alias("centers"),
        unquoted("FromDate").cast("date").alias("from_date"),
        unquoted("ToDate").cast("date").alias("to_date"),
    )


def query(spark: SparkSession, sql: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """A SQL query with named parameters (:name); frames are referred to as {name}."""
    return spark.sql(sql, args=params or {}, **frames)
