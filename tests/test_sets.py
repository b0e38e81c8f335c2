from datetime import datetime

import pytest

from claimweave.operators import sets
from claimweave.operators.chunks import process_in_chunks
from row_sets import rows


def test_union_removes_duplicates_within_a_side_only(spark):
    sent = spark.createDataFrame([("1", "p", "v")] * 2, "claimid string, patientid string, visit_id string")
    pending = spark.createDataFrame([("1", "p", "v")] * 3, "claim_id string, patient_id string, visit_id string")
    got = sets.claims_union(sent, pending)
    assert got.count() == 2 and len(got.columns) == 17


TARGET = "k string, at timestamp_ntz, v string"


def test_upsert(spark):
    day = lambda d: datetime(2024, 1, d)
    target = spark.createDataFrame([("a", day(1), "old"), ("b", day(1), "old"), (None, day(1), "null key")], TARGET)
    batch = spark.createDataFrame(
        [("a", day(2), "x"), ("a", day(3), "y"), ("a", day(3), "w"), ("c", day(1), "new"), (None, day(9), "n1"), (None, day(9), "n2")],
        TARGET,
    )
    once = sets.upsert(target, batch, ["k"], "at")
    assert sorted((str(r.k), r.v) for r in once.collect()) == [
        ("None", "n1"), ("None", "n2"), ("None", "null key"), ("a", "y"), ("b", "old"), ("c", "new"),
    ]
    keyed = batch.where("k is not null")
    first = sets.upsert(target, keyed, ["k"], "at")
    assert rows(sets.upsert(first, keyed, ["k"], "at")) == rows(first)


def test_upsert_with_empty_sides(spark):
    some = spark.createDataFrame([("a", None, "x")], TARGET)
    none = some.where("false")
    assert rows(sets.upsert(none, some, ["k"], "at")) == rows(some) == rows(sets.upsert(some, none, ["k"], "at"))


def test_distinct_key_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "x string, y int")
    assert rows(sets.distinct_key_counts(df, ["x", "y"])) == [("x", 2), ("y", 1)]
    assert rows(sets.load_audit(df, "t")) == [("t", 3)]


def test_pages_cover_the_table(spark):
    df = spark.createDataFrame([(i // 3, i % 3) for i in range(20)], "a int, b int").repartition(4)
    whole = rows(df)
    by_offset = [tuple(r) for k in range(0, 20, 6) for r in sets.page(df, ["a", "b"], 6, k).collect()]
    assert by_offset == whole
    by_key, last = [], None
    while part := [tuple(r) for r in sets.page_after(df, ["a", "b"], 6, last).collect()]:
        by_key += part
        last = list(part[-1])
    assert by_key == whole


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_chunks(spark, size):
    def double(chunk, factor):
        assert len(chunk) <= size
        return chunk.assign(v=chunk["v"] * factor)

    df = spark.createDataFrame([(i, i) for i in range(50)], "id long, v long")
    assert rows(process_in_chunks(df, double, df.schema, size, factor=2)) == sorted(((i, 2 * i) for i in range(50)), key=repr)
    assert process_in_chunks(df.where("false"), double, df.schema, size, factor=2).count() == 0


def test_upsert_of_some_columns_keeps_the_others(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    batch = spark.createDataFrame([("a", 9), ("c", 3)], "k string, v int")
    assert rows(sets.upsert(target, batch, ["k"])) == [("a", 9, "x"), ("b", 2, "y"), ("c", 3, None)]
