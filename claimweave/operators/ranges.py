"""Places of values among sorted bounds, as expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimweave.operators.keys import nulls_last

#: Rows of a piece, as a rule: what one task sorts.
ROWS_PER_PIECE = 1 << 20


def place_of(value: Column, starts: list, constant: Callable[[list], Column]) -> Column:
    """Which of the ranges a value lies in: 0 before the first start, then 1 from it on, and so on. Nulls come first.

    ``constant`` makes an array of starts. They are searched by halving, so ten thousand bounds cost fourteen comparisons.
    """
    if not starts:
        return F.lit(0)
    bounds = constant(starts)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(starts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= value, at + step).otherwise(at))


def even_starts(df: DataFrame, column: str, n: int, per_range: int = 100) -> list:
    """Starts that cut the values of a column into n ranges of about equal numbers of rows; fewer if values repeat.

    Of any ordered type. They come from a sample of about ``per_range`` values a range, which is what the driver holds.
    """
    if n < 2:
        return []
    known = df.select(column).where(F.col(column).isNotNull())
    rows = known.count()
    if rows == 0:
        return []
    sample = sorted(r[0] for r in known.sample(min(1.0, n * per_range / rows), seed=1).collect())
    return sorted({sample[len(sample) * i // n] for i in range(1, n)}) if sample else []


def pieces_for(df: DataFrame, rows: int, rows_per_piece: int = ROWS_PER_PIECE) -> int:
    """How many pieces so many rows are dealt to: the session's shuffle partitions, and more for more rows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_piece))


def even_tiles(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """ntile(n) in the order of the keys, nulls last: (*keys, tile from 0, rows), how many rows of each key lie in which tile.

    Rows of equal keys are cut where the tile ends, which predicates on the keys can't do. They are one row with their number here; those
    are placed piece by piece (ranges of the keys), and the driver holds a start and a sum per piece. No task sorts the whole.
    """
    at = nulls_last(keys)
    rows = df.select(*keys, at.alias("_at"))
    kind = rows.schema["_at"].dataType
    pieces = pieces_for(df, df.count())
    constant = lambda values: F.array(*[F.struct(*[F.lit(v) for v in row]).cast(kind) for row in values])
    starts = even_starts(rows, "_at", pieces)
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_at", at)
    placed = groups.withColumn("_piece", place_of(F.col("_at"), starts, constant))
    sums = dict(placed.groupBy("_piece").agg(F.sum("_n")).collect())
    total, before, offsets = sum(sums.values()), 0, []
    for piece in range(len(starts) + 1):
        offsets.append(before)
        before += sums.get(piece, 0)
    size, longer = divmod(total, n)  # the first `longer` tiles have one more

    def tile_of(place: Column) -> Column:
        rest = F.floor((place - longer * (size + 1)) / max(size, 1)) + longer
        return F.when(place < longer * (size + 1), F.floor(place / (size + 1))).otherwise(rest).cast("int")

    def start_of(tile: Column) -> Column:
        return tile.cast("long") * size + F.least(tile, F.lit(longer))

    so_far = F.sum("_n").over(Window.partitionBy("_piece").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offset = F.get(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("_piece"))
    ranged = placed.withColumn("_end", offset + so_far).withColumn("_first", F.col("_end") - F.col("_n"))
    tiled = ranged.select(*keys, "_first", "_end", F.explode(F.sequence(tile_of(F.col("_first")), tile_of(F.col("_end") - 1))).alias("tile"))
    held = F.least("_end", start_of(F.col("tile") + 1)) - F.greatest("_first", start_of(F.col("tile")))
    return tiled.select(*keys, "tile", held.alias("rows"))
