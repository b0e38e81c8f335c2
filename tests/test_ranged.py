import random
from datetime import date

import pytest

from claimweave.operators.sets import upsert
from claimweave.sinks import snapshots
from claimweave.sinks.ranged import RangedTable
from claimweave.sinks.snapshots import Snapshots
from row_sets import rows

SCHEMA = "a string, b date, v int, w string"


def table_rows(seed, n, keys=500):
    rng, made = random.Random(seed), {}
    for i in range(n):
        key = (f"k{rng.randrange(keys):03d}", date(2024, 1, 1 + rng.randrange(3)))
        made[key] = (*key, i, rng.choice(["x", None]))
    return list(made.values())


def files(spark, table):
    return {p["path"]: (tuple(map(str, p["low"])), p["rows"]) for p in table.pieces()}


def test_upserts_equal_the_whole_rewrite_and_leave_other_files(spark, tmp_path):
    frame = spark.createDataFrame(table_rows(1, 900), SCHEMA)
    table = RangedTable(spark, str(tmp_path / "t"), rows_per_piece=50)
    table.create(frame, ["a", "b"])
    assert rows(table.read()) == rows(frame) and len(table.pieces()) > 10
    want = frame
    batches = [
        [("k100", date(2024, 1, 1), -1, "new"), ("k100", date(2024, 1, 1), -2, None), ("k1005", date(2024, 1, 1), -3, "inserted")],
        [("a", date(2024, 1, 1), -4, "before all"), ("z", date(2024, 1, 1), -5, "behind all")],
        [(None, date(2024, 1, 1), -6, "no key"), (None, date(2024, 1, 1), -6, "no key")],
        [(f"k2{i:02d}x", date(2024, 1, 2), i, "many") for i in range(100)],
    ]
    for batch in batches:
        updates = spark.createDataFrame(batch, SCHEMA)
        before = files(spark, table)
        n = table.upsert(updates, "v")
        want = spark.createDataFrame(upsert(want, updates, ["a", "b"], "v").collect(), SCHEMA)
        assert rows(table.read()) == rows(want)
        after = files(spark, table)
        assert 1 <= n <= 12 and len(set(before) - set(after)) == n
        assert sum(k for _, k in after.values()) == want.count()
        lows = [p["low"] for p in table.pieces()]
        highs = [p["high"] for p in table.pieces()]
        key = lambda x: tuple((v is not None, v or "") for v in x)
        assert [(h, low) for h, low in zip(highs[:-1], lows[1:], strict=True) if key(h) >= key(low) and None not in h] == []
    assert table.upsert(spark.createDataFrame([], SCHEMA)) == 0


def test_an_empty_table_takes_its_first_batch(spark, tmp_path):
    table = RangedTable(spark, str(tmp_path / "t"))
    table.create(spark.createDataFrame([], SCHEMA), ["a"])
    assert table.read().count() == 0
    batch = spark.createDataFrame(table_rows(2, 5), SCHEMA)
    assert table.upsert(batch.dropDuplicates(["a"])) == 1
    assert rows(table.read()) == rows(batch.dropDuplicates(["a"]))


def test_a_failed_upsert_changes_nothing(spark, tmp_path, monkeypatch):
    frame = spark.createDataFrame(table_rows(3, 300), SCHEMA)
    table = RangedTable(spark, str(tmp_path / "t"), rows_per_piece=50)
    table.create(frame, ["a", "b"])
    batch = spark.createDataFrame([("k100", date(2024, 1, 1), -1, "new")], SCHEMA)
    with monkeypatch.context() as patch:
        patch.setattr(snapshots.Snapshots, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.upsert(batch)
    assert rows(table.read()) == rows(frame) and Snapshots(spark, str(tmp_path / "t")).unfinished()
    table.upsert(batch)
    assert rows(table.read()) == rows(upsert(frame, batch, ["a", "b"]))


def test_many_bounds_are_searched_in_two_steps(spark, tmp_path):
    frame = spark.range(3000).selectExpr("id * 2 AS k", "'old' AS v")
    table = RangedTable(spark, str(tmp_path / "t"), rows_per_piece=10)
    table.create(frame, ["k"])
    assert len(table.pieces()) > 200
    keys = [1, 4000, 5999, 128 * 20]
    before = files(spark, table)
    n = table.upsert(spark.createDataFrame([(k, "new") for k in keys], "k long, v string"))
    assert n == len(keys) and len(set(before) - set(files(spark, table))) == n
    got = dict(rows(table.read()))
    assert all(got[k] == "new" for k in keys) and len(got) == 3002


def test_any_page_reads_its_own_pieces(spark, tmp_path):
    frame = spark.createDataFrame(table_rows(5, 900), SCHEMA)
    table = RangedTable(spark, str(tmp_path / "t"), rows_per_piece=60)
    table.create(frame, ["a", "b"])
    want = [tuple(r) for r in frame.orderBy("a", "b").collect()]
    for size in (1, 45, 60, 200, 5000):
        for number in {0, 1, len(want) // size // 2, len(want) // size, len(want) // size + 1}:
            page = table.page(number, size)
            assert [tuple(r) for r in page.collect()] == want[number * size : (number + 1) * size]
            assert len(page.inputFiles()) <= 2 + size // 30
    table.upsert(spark.createDataFrame([("k0000", date(2024, 1, 1), 1, "first")], SCHEMA))
    assert [r.a for r in table.page(0, 1).collect()] <= ["k0000"]
