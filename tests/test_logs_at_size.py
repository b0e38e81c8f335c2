"""Lines are shuffled once, to parts that grow with them, and matched once."""

import re

from pyspark.sql import functions as F

from claimweave.functions import logtext
from claimweave.operators import logs
from claimweave.registry import queries
from row_sets import rows

HEAD = "2024-01-01 00:00:0{s} [10.0.0.1] [u] INFO {text}"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_all_steps_read_one_shuffle_of_lines(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join(HEAD.format(s=i, text=f"m{i}") for i in range(9)))
    lines = queries.log_sources.read_log_lines(spark, str(tmp_path))
    plain = re.sub(r"#\d+L?", "", re.sub(r"[:+|]", " ", optimized(logs.assemble_entries(lines))))
    shuffled = [part.split("Relation")[0].split() for part in plain.split("RepartitionByExpression")[1:]]
    assert len(shuffled) > 1 and all(part == shuffled[0] for part in shuffled)


def test_parts_grow_with_the_lines(spark, monkeypatch):
    monkeypatch.setattr(logs, "ROWS_PER_PART", 10)
    table = spark.range(1000).select(F.concat(F.lit("f"), F.col("id") % 2).alias("file"), F.col("id").alias("pos"), F.lit(HEAD.format(s=1, text="m")).alias("line"))
    assert re.search(r"RepartitionByExpression \[file#\d+, block#\d+L?\], 100\b", optimized(logs.assemble_entries(logs.lines_from_table(table, rows_per_block=5))))


def test_one_match_gives_what_a_match_per_field_gives(spark):
    texts = ["m", "f (A.java:1) : a]b]c", "]]", "two\nlines ]", "", "$1 \\n ]", " x ", "a [b] [c] INFO d"]
    lines = [HEAD.format(s=1, text=t) for t in texts] + ["2024-13-45 00:00:01 [a\nb] [ c ] X y", "2024-01-01\t00:00:01  [é$2]\t[\\] W  z ", None]
    df = spark.createDataFrame([(t,) for t in lines], "line string")
    one, each = df.select(*logtext.entry_fields(F.col("line"))), df.select(*logtext.header_fields(F.col("line")))
    assert one.schema == each.schema and one.collect() == each.collect()


def test_lines_of_equal_or_no_position_are_kept(spark):
    placed = [("a", 0, HEAD.format(s=1, text="one")), ("a", 4, "tail"), ("a", 5, HEAD.format(s=2, text="two")), ("a", 5, "same place")]
    df = spark.createDataFrame([*placed, ("b", None, "x"), ("b", None, HEAD.format(s=3, text="three"))], "file string, pos long, line string")
    got = logs.assemble_entries(logs.lines_from_table(df, rows_per_block=4)).select("message", "details")
    assert rows(got) == rows(spark.createDataFrame([("one", "tail"), ("two", "same place"), ("three", "x")], got.schema))
