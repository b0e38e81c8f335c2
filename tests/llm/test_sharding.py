import zlib
from collections import Counter

from pyspark.sql import functions as F

from llm import sharding


def test_rows_sizes_and_gapless_slots(docs, no_docs):
    got = sharding.assign(docs, rows_per_group=1).collect()
    want = [(r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect()]
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(want, key=repr)
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    by_id = {}
    for r in got:
        assert by_id.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
    assert sharding.assign(no_docs).count() == 0


def test_a_new_shard_takes_rows_only_into_itself_and_shares_are_even(spark):
    out = sharding.assign(spark.range(20_000).selectExpr("id AS doc_id", "cast(id AS string) AS text")).collect()
    moved = [r for r in out if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {40} and 20_000 / 41 * 0.7 < len(moved) < 20_000 / 41 * 1.3
    counts = Counter(r.shard for r in out)
    assert set(counts) == set(range(40)) and max(counts.values()) < 500 * 1.25


def test_weights_move_rows_of_changed_subtrees_only(spark):
    before = sharding.tree(3, 2, 2)
    (first, *rest) = before.regions
    heavier = sharding.Tree((((((0, 3.0), (1, 1.0))), first[1]), *rest))
    keys = spark.range(8_000).select(sharding.shard_of(F.col("id"), before).alias("a"), sharding.shard_of(F.col("id"), heavier).alias("b")).collect()
    moves = {(r.a, r.b) for r in keys if r.a != r.b}
    region = lambda s: s // 4
    # Into the heavier region, or inside it: never between others, and never out of it.
    assert moves and all(region(b) == 0 for _, b in moves)
    inside = {(a, b) for a, b in moves if region(a) == 0}
    assert all(b // 2 == 0 for _, b in inside) and (0, 1) not in inside
    assert sum(r.b == 0 for r in keys) > 2 * sum(r.a == 0 for r in keys)
