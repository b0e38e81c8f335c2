import pytest

from claimweave.operators.updates import plan_attributes, update_from
from claimweave.plans.claim_wide import MASTER_KEYS, ClaimSources
from claimweave.plans.runs import DimSpec, refresh_dims
from claimweave.sources.contracts import ContractError, Keyed, checked, is_unique, read_keyed
from row_sets import rows


def test_a_unique_source_joins_without_an_aggregate(spark):
    target = spark.createDataFrame([("a", "old"), ("b", "old"), (None, "old"), ("d", "old")], "k string, v string")
    source = spark.createDataFrame([("a", "new"), ("b", None), (None, "null key"), (None, "null key")], "k string, w string")
    keyed = checked({"source": (source, ["k"])})["source"]
    plain, spared = (update_from(target, s, {"k": "k"}, {"v": "w"}) for s in (source, keyed))
    assert rows(spared) == rows(plain) == [("a", "new"), ("b", None), ("d", "old"), (None, "old")]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan(plain) and "Aggregate" not in plan(spared)


def test_a_violated_contract_fails(spark):
    twice = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    pairs = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ContractError, match=r"masters: 1 keys \['k'\] occur more than once, such as \[\"1\"\]"):
        checked({"masters": (twice, ["k"]), "pairs": (pairs, ["k", "v"])})
    assert checked({"pairs": (pairs, ["k", "v"])})["pairs"].keys == ("k", "v")


def test_uniqueness_of_joined_masters_needs_both(spark):
    plan = spark.createDataFrame([(1, "p", 7)], "plan_id int, plan_name string, category_id int")
    category = spark.createDataFrame([(7, "c")], "category_id int, category_name string")
    both = plan_attributes(Keyed(plan, ("plan_id",)), Keyed(category, ("category_id",)))
    assert is_unique(both, ["plan_id"]) and not is_unique(both, ["insurance_plan"])
    assert not is_unique(plan_attributes(Keyed(plan, ("plan_id",)), category), ["plan_id"])


def test_a_refresh_counts_once_and_refuses_repeated_keys(spark, tmp_path):
    good = spark.createDataFrame([("1", "a"), ("2", "b")], "tpa_id string, tpa_name string")
    refresh_dims([DimSpec("tpa", good, unique=("tpa_id",)), DimSpec("other", good)], str(tmp_path))
    saved = read_keyed(spark, f"{tmp_path}/tpa")
    assert is_unique(saved, ["tpa_id"]) and rows(saved.frame) == rows(good)
    assert not isinstance(read_keyed(spark, f"{tmp_path}/other"), Keyed)
    with pytest.raises(ContractError, match="tpa_id"):
        refresh_dims([DimSpec("tpa", good.union(good), unique=("tpa_id",))], str(tmp_path))
    assert rows(read_keyed(spark, f"{tmp_path}/tpa").frame) == rows(good)


def test_claim_sources_are_counted_in_one_job(spark):
    frames = {n: spark.createDataFrame([("1",), ("2",)], f"{keys[0]} string") for n, keys in MASTER_KEYS.items()}
    sources = ClaimSources(**frames, diagnosis=frames["tpa"], observation=frames["tpa"])
    counted = sources.with_unique_keys()
    assert all(is_unique(getattr(counted, n), list(k)) for n, k in MASTER_KEYS.items())
    assert counted.with_unique_keys() is counted
