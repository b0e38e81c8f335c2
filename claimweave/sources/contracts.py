"""Unique keys as checked contracts: a source that declares its key is counted once, and joins may then rely on it.

Joins compare keys as text, so that is what is counted. Rows with a null in the key match nothing and don't count.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimweave.sinks.folders import put_text, read_text

_MARK = "_unique_key.json"  # in a table's folder, where scans pass over it


class ContractError(ValueError):
    """A declared key occurs more than once."""


@dataclass(frozen=True)
class Keyed:
    """A frame known to have at most one row per key. Made by `checked`, `read_keyed`, or by operators whose inputs are."""

    frame: DataFrame
    keys: tuple[str, ...]

    def with_frame(self, frame: DataFrame, *keys: str) -> Keyed:
        """The same rows, or fewer, in another layout; keys are what the columns of the key are called there."""
        return Keyed(frame, keys or self.keys)


Source = DataFrame | Keyed


def frame_of(source: Source) -> DataFrame:
    return source.frame if isinstance(source, Keyed) else source


def is_unique(source: Source, keys: list[str]) -> bool:
    """Whether the source has at most one row per combination of these columns."""
    return isinstance(source, Keyed) and set(source.keys) <= set(keys)


def checked(declared: dict[str, tuple[DataFrame, list[str]]]) -> dict[str, Keyed]:
    """Count the declared keys of all sources in one job, which reads key columns only; a repeated key is an error."""

    def listed(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        return df.where(known).select(F.lit(name).alias("source"), F.to_json(F.array(*[F.col(k).cast("string") for k in keys])).alias("key"))

    every = reduce(DataFrame.unionByName, [listed(n, df, keys) for n, (df, keys) in declared.items()])
    repeated = every.groupBy("source", "key").agg(F.count("*").alias("n")).where("n > 1")
    found = repeated.groupBy("source").agg(F.count("*").alias("keys"), F.min("key").alias("example")).collect()  # a row per source at most
    if found:
        raise ContractError("; ".join(f"{r.source}: {r.keys} keys {declared[r.source][1]} occur more than once, such as {r.example}" for r in found))
    return {n: Keyed(df, tuple(keys)) for n, (df, keys) in declared.items()}


def mark_unique(spark: SparkSession, path: str, keys: list[str]) -> None:
    """Note in a table's folder that its key has been counted."""
    put_text(spark, f"{path.rstrip('/')}/{_MARK}", json.dumps(list(keys)), replace=True)


def read_keyed(spark: SparkSession, path: str) -> Source:
    """A table, as Keyed if its key was counted when it was written."""
    keys = read_text(spark, f"{path.rstrip('/')}/{_MARK}")
    table = spark.read.parquet(path)
    return Keyed(table, tuple(json.loads(keys))) if keys else table
