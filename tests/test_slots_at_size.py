from pyspark.sql import functions as F

from claimweave.operators import pivots
from row_sets import rows


def test_usual_and_hot_groups_get_the_same_labels(spark, monkeypatch):
    monkeypatch.setattr(pivots, "HOT_ROWS", 20)
    items = [(None, "S", f"I{i % 7}", f"{i:03d}") for i in range(90)] + [("v", "S", f"I{i % 3}", f"{i}") for i in range(9)]
    items += [("v", None, "I", "1"), ("w", "P", None, None), ("w", "S", None, None), ("w", "S", "A", None)]
    df = spark.createDataFrame(items, "visit_id string, diag_type string, icd_code string, id string")
    assert rows(pivots.slot_labels(df)) == rows(pivots.slot_labels(df, 3)) and pivots.slot_labels(df).count() == len(items)


def test_usual_groups_take_one_shuffle(spark):
    df = spark.createDataFrame([("v", "S", "A", "1")], "visit_id string, diag_type string, icd_code string, id string")
    plan = pivots.slot_labels(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
