from pyspark.sql import Window, functions as F
import pytest

from claimweave.operators.ranges import even_tiles, place_of
from claimweave.registry.queries import QUERIES
from row_sets import rows


@pytest.mark.parametrize("n", [1, 3, 7, 10, 100])
def test_tiles_are_those_of_ntile(spark, n):
    """Equal keys lie across the ends of tiles, and one key fills several."""
    items = [("a", i // 3) for i in range(20)] + [("b", 1)] * 30 + [("b", None), (None, 2), (None, None)]
    df = spark.createDataFrame(items, "k string, v int")
    tile = F.ntile(n).over(Window.orderBy(F.asc_nulls_last("k"), F.asc_nulls_last("v"))) - 1
    want = df.select("k", "v", tile.alias("tile")).groupBy("k", "v", "tile").agg(F.count("*").alias("rows"))
    assert rows(even_tiles(df, ["k", "v"], n)) == rows(want)


def test_tiles_of_an_empty_table(spark):
    assert rows(even_tiles(spark.createDataFrame([], "k string"), ["k"], 4)) == []


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 300])
def test_places_among_starts(spark, n):
    starts = [3 * i for i in range(n)]
    got = spark.range(-2, 3 * n + 2).select("id", place_of(F.col("id"), starts, lambda v: F.array(*[F.lit(x) for x in v])).alias("p"))
    assert all(p == sum(s <= i for s in starts) for i, p in got.collect())


def test_range_scan_cuts_equal_keys(spark, tmp_path):
    items = [("A", 1, 1)] * 25 + [("R", 2, 1)] * 4
    columns = "l_returnflag string, l_orderkey long, l_linenumber int"
    spark.createDataFrame(items, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r.slice: (r.row_count, r.least, r.key_sum) for r in QUERIES["range_scan"](spark, str(tmp_path)).collect()}
    assert got == {**{i: (3, "A", 3) for i in range(8)}, 8: (3, "A", 5), 9: (2, "R", 4)}
