"""Equi joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def distinct_keys(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Non-null distinct values of one column, as a frame (never a driver-side list)."""
    return df.select(F.col(column).cast("string").alias(alias or column)).where(F.col(column).isNotNull()).distinct()


def nulls_last(columns: list[str]) -> Column:
    """A sortable struct that orders by the columns with nulls after all values."""
    return F.struct(*[f for c in columns for f in (F.col(c).isNull().alias(f"{c}_is_null"), F.col(c))])


def one_per_key(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """The first row of every key under the given order.

    An aggregate, not a window: map tasks reduce each key to one row before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by or []) + [c for c in rest if c not in (order_by or [])]
    if not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), nulls_last(order)).alias("picked"))
    return picked.select(*keys, "picked.*").select(*df.columns)


def key_join(left: DataFrame, right: DataFrame, on: dict[str, str], how: str = "inner") -> DataFrame:
    """Join on keys compared as text; keeps the left columns and the right non-key columns.

    Every key is paired with its hash. The pair makes Spark shuffle both sides right
    below the join even if one of them is already partitioned by the key, and that is the
    shape in which AQE can split a hot key over many tasks. Rows with a null key match
    nothing, so an outer join spreads them by a hash of the whole row. Small sides
    are still broadcast, by Spark's own size check.
    """
    left_keys = [F.col(c).cast("string") for c in on]
    right_keys = [F.col(c).cast("string") for c in on.values()]
    left_names = [f"_left_{c}" for c in on]
    right_names = [f"_right_{c}" for c in on.values()]
    # The hashes are no columns: eight bytes of noise in each shuffled row, while they follow from the keys.
    left_hash, spread = F.xxhash64(*left_names), []
    if how in ("left", "left_anti"):
        any_null = reduce(lambda a, b: a | b, [k.isNull() for k in left_keys])
        spread = [F.when(any_null, F.xxhash64("*")).alias("_left_spread")]
        left_hash = F.coalesce("_left_spread", left_hash)
    lhs = left.select("*", *[k.alias(n) for n, k in zip(left_names, left_keys)], *spread)
    rhs = right.select("*", *[k.alias(n) for n, k in zip(right_names, right_keys)]).drop(*on.values())
    matched = [F.col(a) == F.col(b) for a, b in zip(left_names, right_names)]
    joined = lhs.join(rhs, reduce(lambda a, b: a & b, matched, left_hash == F.xxhash64(*right_names)), how)
    return joined.drop(*left_names, *right_names, "_left_spread")


def keep_keys(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose column is among the keys; an empty key frame keeps nothing."""
    return key_join(df, keys, {column: keys.columns[0]}, "left_semi")


def drop_keys(df: DataFrame, columns: list[str], keys: DataFrame) -> DataFrame:
    """Rows whose columns are not among the keys; a null column is never among them."""
    return key_join(df, keys, {c: c for c in columns}, "left_anti")
