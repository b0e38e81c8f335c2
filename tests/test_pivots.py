import random

import pytest
from pyspark.sql import functions as F

from claimweave.functions.scalars import slot_label
from claimweave.operators import pivots
from claimweave.operators.ranges import even_starts, place_of
from row_sets import rows

DIAG = "visit_id string, diag_type string, icd_code string, id string"


def diag(spark, *items):
    """items: (visit, type, code); ids follow the order given"""
    return spark.createDataFrame([(v, t, c, f"{i:03d}") for i, (v, t, c) in enumerate(items)], DIAG)


def filled(row, *names):
    return [getattr(row, n) for n in names]


def test_principal_and_secondaries(spark):
    got = pivots.diag_pivot_typed(diag(spark, ("v", "S", "b"), ("v", "P", "x"), ("v", "S", "a"))).first()
    assert filled(got, "p1", "s1", "s2", "s3") == ["x", "a", "b", None]


def test_visit_without_principal(spark):
    df = diag(spark, ("v", "S", "b"), ("v", "S", "a"))
    assert filled(pivots.diag_pivot_typed(df).first(), "p1", "s1", "s2") == [None, "a", "b"]
    assert filled(pivots.diag_pivot_positional(df).first(), "p1", "s1", "s2") == ["a", "b", None]


def test_other_types(spark):
    df = diag(spark, ("v", "P", "x"), ("v", "S", "a"), ("v", "V", "z"), ("w", "V", "q"), ("u", None, "n"))
    typed = {r.visit_id: r for r in pivots.diag_pivot_typed(df).collect()}
    assert filled(typed["v"], "p1", "s1", "s2") == ["x", "a", None]
    assert set(typed["w"][1:]) == {None} and set(typed["u"][1:]) == {None}
    positional = {r.visit_id: r for r in pivots.diag_pivot_positional(df).collect()}
    assert filled(positional["v"], "p1", "s1", "s2") == ["x", "a", "z"]


def test_overflow(spark):
    df = diag(spark, ("v", "P", "P0"), *[("v", "S", f"S{i:02d}") for i in range(17)])
    typed = pivots.diag_pivot_typed(df).first()
    assert list(typed[1:]) == ["P0"] + [f"S{i:02d}" for i in range(15)]
    positional = pivots.diag_pivot_positional(df).first()
    assert list(positional[1:]) == ["P0"] + [f"S{i:02d}" for i in range(15)]


def test_largest_of_many_principals(spark):
    df = diag(spark, *[("v", "P", f"P{i:02d}") for i in range(40)], ("v", "P", None))
    assert pivots.diag_pivot_typed(df).first().p1 == "P39"


def test_explicit_order_takes_the_largest_of_a_tie(spark):
    df = spark.createDataFrame(
        [("v", 1, "a"), ("v", 1, "b"), ("v", 16, "z"), ("v", 17, "dropped"), ("v", None, "n")],
        "visit_id string, diag_order int, diagnosis_code string",
    )
    assert filled(pivots.diag_pivot_ordered(df).first(), "p1", "s1", "s15") == ["b", None, "z"]


def test_first_five_observations(spark):
    items = [("c", "t", f"c{i}", str(i), None) for i in range(6, -1, -1)] + [("c", "a", None, "v", "Text")]
    df = spark.createDataFrame(items, "charge_id string, observation_type string, code string, value string, value_type string")
    got = pivots.obs_pivot(df).first()
    assert filled(got, "code1", "obstype1", "value1", "valuetype1") == [None, "a", "v", "Text"]
    assert filled(got, "code2", "code3", "code4", "code5") == ["c0", "c1", "c2", "c3"]


def test_pivot_first(spark):
    df = spark.createDataFrame(
        [("i", "a", None, 1), ("i", "a", "x", 2), ("i", "a", "y", 3), ("j", "b", "z", 1), ("k", "a", None, 1), (None, "a", "q", 1)],
        "i string, c string, v string, o int",
    )
    got = pivots.pivot_first(df, "i", "c", "v", ["a", "b"], ["o"], fill="-")
    assert rows(got) == [("i", "x", "-"), ("j", "-", "z")]
    assert rows(pivots.pivot_first(df, "i", "c", "v", None, ["o"], fill="-")) == rows(got)
    with pytest.raises(Exception, match="not listed"):
        pivots.pivot_first(df, "i", "c", "v", ["a"], ["o"]).collect()
    with pytest.raises(ValueError, match="more than 1"):
        pivots.pivot_first(df, "i", "c", "v", None, ["o"], most_columns=1)


def test_slot_labels_have_no_cap(spark):
    items = [("v", "S", f"I{i // 3:02d}", f"{i:04d}") for i in range(40)] + [("v", "P", "X", "1"), ("w", "S", None, "2"), ("w", "S", "A", "3"), (None, "S", "A", "4")]
    got = rows(pivots.slot_labels(spark.createDataFrame(items, DIAG)).where("visit_id = 'v'").select("slot"))
    assert sorted(r[0] for r in got) == sorted([f"S{i}" for i in range(1, 41)] + ["P"])


def test_pivots_do_not_depend_on_input_order(spark):
    rng = random.Random(5)
    items = [(f"v{rng.randrange(20)}", rng.choice("PSSSV"), f"I{rng.randrange(30)}", f"{i:04d}") for i in range(600)]
    shuffled = rng.sample(items, len(items))
    a, b = spark.createDataFrame(items, DIAG), spark.createDataFrame(shuffled, DIAG).repartition(7)
    for pivot in (pivots.diag_pivot_typed, pivots.diag_pivot_positional):
        assert rows(pivot(a)) == rows(pivot(b))


def test_ranked_pivots_limit_in_the_map_tasks(spark):
    """Below the first shuffle there must be a partial group limit, or a hot visit would move whole."""
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr(
        "l_orderkey AS visit_id", "l_returnflag AS diag_type", "l_linestatus AS icd_code", "l_partkey AS id",
        "l_orderkey AS charge_id", "l_returnflag AS observation_type", "l_linestatus AS code",
        "'v' AS value", "'t' AS value_type",
    )
    for pivot in (pivots.diag_pivot_typed, pivots.diag_pivot_positional, pivots.obs_pivot):
        plan = pivot(lineitem)._jdf.queryExecution().executedPlan().toString().split("\n")
        last_shuffle = max(i for i, line in enumerate(plan) if "Exchange" in line)
        assert any("WindowGroupLimit" in line and "Partial" in line for line in plan[last_shuffle:])


@pytest.mark.parametrize("pieces", [1, 3, 200])
def test_slots_of_a_hot_group_by_pieces(spark, pieces):
    """All rows without a visit are one group; its rows are ranked in pieces of the id."""
    rng = random.Random(4)
    items = [(None if i % 2 else f"v{i % 7}", rng.choice(["P", "S", None]), rng.choice(["c1", "c2", "c3", None]), i * 37 % 1000 if i % 50 else None) for i in range(900)]
    frame = spark.createDataFrame(items, "visit_id string, diag_type string, icd_code string, id long")
    groups, want = {}, []
    for item in items:
        groups.setdefault(item[:2], []).append(item)
    last = lambda v: (v is not None, v if v is not None else 0)
    for (visit, kind), own in groups.items():
        own.sort(key=lambda r: ((r[2] is not None, r[2] or ""), last(r[3])))
        want += [(visit, kind, r[2], n) for n, r in enumerate(own, 1)]
    labels = spark.createDataFrame(want, "visit_id string, diag_type string, icd_code string, n int")
    labels = labels.select("visit_id", "icd_code", slot_label(F.col("diag_type"), F.col("n")).alias("slot"))
    got = pivots.slot_labels(frame, pieces)
    assert rows(got) == rows(labels)
    if pieces == 200:
        places = frame.select(place_of(F.col("id"), even_starts(frame, "id", pieces), lambda v: F.array(*[F.lit(x) for x in v])).alias("p"))
        assert places.groupBy("p").count().agg(F.max("count")).first()[0] < 40
