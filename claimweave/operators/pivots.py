"""Repeating groups flattened to numbered columns.

Each ranked pivot keeps a small number of rows per key. The limit sits directly on the
row_number, so Spark applies it in the map tasks too (WindowGroupLimit): a key that
holds a large share of all rows reaches its reducer as a few rows per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimweave.functions.scalars import slot_label
from claimweave.operators.keys import nulls_last
from claimweave.operators.ranges import even_starts, pieces_for, place_of
from claimweave.schemas import (
    DIAG_SLOTS,
    OBS_ATTRIBUTES,
    OBSERVATION_SLOTS,
    SECONDARY_SLOTS,
)


def _ascending(*columns: str):
    return [F.col(c).asc_nulls_last() for c in columns]


def _cell(condition: str, value: str, name: str) -> Column:
    """The largest value among the key's rows that meet the condition; null if none does."""
    return F.expr(f"max(CASE WHEN {condition} THEN {value} END) AS {name}")


def diag_pivot_typed(diagnosis: DataFrame) -> DataFrame:
    """Per visit the largest principal code and the first 15 secondary codes.

    Other diagnosis types fill no slot, but their visits keep a row, and so do rows without a code. Principal rows are
    ranked by descending code, so that their maximum is rank 1 and the limit cannot lose it. Equal codes fill equal slots in any order, so
    neither the id nor the type's text is shuffled, and each code once.
    """
    principal, secondary = (F.when(F.col("diag_type") == t, F.col("icd_code")) for t in ("P", "S"))
    coded = diagnosis.select("visit_id", principal.alias("p"), secondary.alias("s"))
    rows = coded.withColumn("kind", F.when(F.col("p").isNotNull(), 1).when(F.col("s").isNotNull(), 2).otherwise(0).cast("byte"))
    order = Window.partitionBy("visit_id", "kind").orderBy(F.col("p").desc_nulls_last(), *_ascending("s"))
    kept = rows.withColumn("slot", F.row_number().over(order)).where(F.col("slot") <= SECONDARY_SLOTS)
    slots = [_cell(f"slot = {i}", "s", f"s{i}") for i in range(1, SECONDARY_SLOTS + 1)]
    return kept.groupBy("visit_id").agg(F.max("p").alias("p1"), *slots)


def diag_pivot_positional(diagnosis: DataFrame) -> DataFrame:
    """The visit's first 16 diagnoses by type, code and id, left to right whatever their type."""
    order = Window.partitionBy("visit_id").orderBy(*_ascending("diag_type", "icd_code", "id"))
    kept = (
        diagnosis.select("visit_id", "diag_type", "icd_code", "id")
        .withColumn("slot", F.row_number().over(order))
        .where(F.col("slot") <= len(DIAG_SLOTS))
    )
    slots = [_cell(f"slot = {i}", "icd_code", name) for i, name in enumerate(DIAG_SLOTS, start=1)]
    return kept.groupBy("visit_id").agg(*slots)


def diag_pivot_ordered(patient_diagnosis: DataFrame) -> DataFrame:
    """Slots by the recorded order: 1 is principal, 2 to 16 secondary; the largest code wins a tie."""
    slots = [_cell(f"diag_order = {i}", "diagnosis_code", name) for i, name in enumerate(DIAG_SLOTS, start=1)]
    return patient_diagnosis.groupBy("visit_id").agg(*slots)


def obs_pivot(observation: DataFrame, slots: int = OBSERVATION_SLOTS) -> DataFrame:
    """The charge's first observations by type, four attributes each."""
    columns = ["observation_type", "code", "value", "value_type"]
    order = Window.partitionBy("charge_id").orderBy(*_ascending(*columns))
    kept = (
        observation.select("charge_id", *columns)
        .withColumn("slot", F.row_number().over(order))
        .where(F.col("slot") <= slots)
    )
    cells = [
        _cell(f"slot = {i}", source, f"{prefix}{i}")
        for prefix, (source, _) in OBS_ATTRIBUTES.items()
        for i in range(1, slots + 1)
    ]
    return kept.groupBy("charge_id").agg(*cells)


def pivot_first(
    df: DataFrame,
    index: str,
    columns: str,
    values: str,
    column_values: list | None,
    order_by: list[str],
    fill=None,
    most_columns: int = 1000,
) -> DataFrame:
    """One column per pivot value, holding the first non-null value under the given order.

    Rows without index, pivot or cell value form no group. Without ``column_values`` a first job finds them, and more than
    ``most_columns`` are an error. With them, a row that holds another value fails the query: none is lost in silence.
    """
    rows = df.where(F.col(index).isNotNull() & F.col(columns).isNotNull() & F.col(values).isNotNull())
    if column_values is None:
        found = rows.select(columns).distinct().limit(most_columns + 1).collect()
        if len(found) > most_columns:
            raise ValueError(f"{columns} has more than {most_columns} values")
        column_values = sorted(r[0] for r in found)
    else:
        unlisted = F.raise_error(F.concat(F.lit(f"{columns} holds a value that is not listed: "), F.col(columns).cast("string")))
        listed = F.when(F.col(columns).isin(column_values), F.col(columns)).otherwise(unlisted.cast(df.schema[columns].dataType))
        rows = rows.withColumn(columns, listed)
    first = F.min_by(F.col(values), nulls_last(order_by))
    pivoted = rows.groupBy(index).pivot(columns, column_values).agg(first)
    return pivoted if fill is None else pivoted.fillna(fill)


#: Diagnoses of one visit and type beyond which they are ranked by pieces.
HOT_ROWS = 1 << 16


def slot_labels(diagnosis: DataFrame, pieces: int | None = None) -> DataFrame:
    """Every diagnosis with the label of its place among the visit's diagnoses of its type, by code and id.

    Groups of usual size are ranked by one window, in parts whose number grows with the rows. Larger ones (two jobs find them; there are
    at most rows / HOT_ROWS), or all of them if ``pieces`` is given, are ranked by pieces.
    """
    if pieces is not None:
        return _slots_by_pieces(diagnosis, pieces)
    group = ["visit_id", "diag_type"]
    counts = diagnosis.groupBy(*group).agg(F.count("*").alias("n")).where(F.col("n") > HOT_ROWS).collect()
    rows = diagnosis.select(*group, "icd_code", "id")
    usual, found = rows, None
    if counts:
        hot = diagnosis.sparkSession.createDataFrame([tuple(r)[:2] for r in counts], diagnosis.select(*group).schema)
        same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(hot[c]) for c in group])
        usual = rows.join(F.broadcast(hot), same, "left_anti")
        found = _slots_by_pieces(rows.join(F.broadcast(hot), same, "left_semi"), pieces_for(diagnosis, sum(r.n for r in counts)))
    # A set number of parts: small ones are not merged to what one task must sort.
    dealt = usual.repartition(pieces_for(diagnosis, diagnosis.count()), *group)
    placed = dealt.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy("icd_code", "id")))
    labels = placed.select("visit_id", "icd_code", slot_label(F.col("diag_type"), F.col("place")).alias("slot"))
    return labels if found is None else labels.unionByName(found)


def _slots_by_pieces(diagnosis: DataFrame, pieces: int) -> DataFrame:
    """Labels of groups of any size.

    A place is the sum of three: rows of earlier codes, rows of the same code in earlier pieces, and the place in the own piece. Pieces
    are ranges of the id with about equal numbers of rows (one job finds their bounds), so a group of any size, such as all rows
    without a visit, is ranked piece by piece in many tasks; sums run over counts only.
    """
    group = ["visit_id", "diag_type", "icd_code"]
    starts = even_starts(diagnosis, "id", pieces)
    constant = lambda values: F.array(*[F.lit(v) for v in values])
    rows = diagnosis.select(*group, "id", place_of(F.col("id"), starts, constant).alias("piece"))
    counts = rows.groupBy(*group, "piece").agg(F.count("*").alias("n"))
    by_code = counts.groupBy(*group).agg(F.sum("n").alias("n"))
    earlier = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    codes = by_code.select(*group, F.coalesce(F.sum("n").over(earlier(*group)), F.lit(0)).alias("of_codes"))
    before = counts.select(*group, "piece", F.coalesce(F.sum("n").over(earlier(*group, "piece")), F.lit(0)).alias("of_pieces"))
    within = rows.withColumn("place", F.row_number().over(Window.partitionBy(*group, "piece").orderBy("id")))
    # Counts meet counts by group; rows meet them by group and piece, so no join key is hot.
    so_far = _same_group(before, codes, group).select(*group, "piece", (F.col("of_codes") + F.col("of_pieces")).alias("so_far"))
    placed = _same_group(within, so_far, [*group, "piece"])
    label = slot_label(F.col("diag_type"), (F.col("so_far") + F.col("place")).cast("int"))
    return placed.select("visit_id", "icd_code", label.alias("slot"))


def _same_group(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the facts of their group, in which null keys are values. Each group is one row of facts."""
    own = facts.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in facts.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(own, same).drop(*[f"_{k}" for k in keys])
