from datetime import datetime

from pyspark.sql import functions as F

from claimweave.operators import filters, projections
from claimweave.operators.keys import distinct_keys, keep_keys
from claimweave.schemas import CLAIM_WIDE
from row_sets import rows


def test_day_range_includes_the_whole_last_day(spark):
    df = spark.createDataFrame(
        [
            (1, datetime(2024, 1, 1)),
            (2, datetime(2024, 1, 31, 23, 59, 59)),
            (3, datetime(2024, 2, 1)),
            (4, datetime(2023, 12, 31, 23, 59, 59)),
            (5, None),
        ],
        "id int, at timestamp_ntz",
    )
    assert [r.id for r in filters.between_days(df, "at", "2024-01-01", "2024-01-31").collect()] == [1, 2]
    text = df.select("id", F.col("at").cast("string").alias("at"))
    assert [r.id for r in filters.between_days(text, "at", "2024-01-01", "2024-01-31").collect()] == [1, 2]


def test_day_range_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = filters.between_days(orders, "o_orderdate", "1996-01-01", "1996-12-31")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_blank_center_list_filters_nothing(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "center_id int")
    for blank in (None, "", " ", [], [""]):
        assert filters.filter_centers(df, blank).count() == 3
    assert rows(filters.filter_centers(df, "1, 3")) == [(1,), (3,)]
    assert rows(filters.filter_centers(df, [2])) == [(2,)]


def test_first_submissions_and_levels(spark):
    assert filters.first_submissions(spark.createDataFrame([(1,), (2,), (None,)], "org_sub_seq int")).count() == 1
    levels = spark.createDataFrame([("ERROR",), ("error",), ("INFO",)], "log_level string")
    assert filters.with_level(levels, "Error").count() == 2


def test_empty_key_set_keeps_nothing(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    none = distinct_keys(df.where("v > 5"), "k")
    assert keep_keys(df, "k", none).count() == 0
    some = distinct_keys(df.where("v <> 2"), "k")
    assert rows(keep_keys(df, "k", some)) == [("a", 1)]


def test_clean_frame(spark):
    df = spark.createDataFrame([(" a ", None), (None, 2)], "Name string, N int")
    cleaned = projections.clean_frame(df)
    assert cleaned.columns == ["name", "n"]
    assert rows(cleaned) == [("", 2), ("a", None)]


def test_project_claim_fact_has_the_contract(spark):
    fact = spark.createDataFrame([("c", "I10", "9", "7")], "claimid string, primary_icd string, org_id string, prior_auth_id string")
    wide = projections.project_claim_fact(fact)
    assert [f.name for f in wide.schema.fields] == [f.name for f in CLAIM_WIDE.fields]
    assert [f.dataType for f in wide.schema.fields] == [f.dataType for f in CLAIM_WIDE.fields]
    assert len(wide.columns) == 91
    got = wide.first()
    assert (got.encounterdiagnosisprincipal, got.rate_plan_id, got.priorauthorizationid, got.age) == ("I10", "9", "7", None)


def test_export_types(spark):
    df = spark.sql(
        "SELECT 1 AS i, 2L AS l, CAST(1.5 AS DECIMAL(9,2)) AS d, CAST(1.5 AS FLOAT) AS f, CAST(3 AS SMALLINT) AS s, "
        "true AS b, DATE '2024-01-02' AS day, TIMESTAMP_NTZ '2024-01-02 03:04:05' AS t, array(1, 2) AS a, 'x' AS x"
    )
    types = {f.name: f.dataType.simpleString() for f in projections.export_schema(df).schema.fields}
    assert types == {
        "i": "int", "l": "bigint", "d": "double", "f": "double", "s": "string", "b": "boolean", "day": "date",
        "t": "timestamp_ntz", "a": "string", "x": "string",
    }
    assert projections.export_schema(df).first().a == "[1,2]"
