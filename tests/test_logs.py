import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimweave.functions import logtext
from claimweave.operators import logs
from claimweave.sources.logs import list_files, read_log_lines
from row_sets import rows

HEAD = "2025-03-17 10:00:0{s} [10.0.0.1] [ann] {level} {text}"


def table_lines(spark, files: dict[str, list[str]], rows_per_block: int):
    data = [(f, i, line) for f, text in files.items() for i, line in enumerate(text)]
    return logs.lines_from_table(spark.createDataFrame(data, "file string, pos long, line string"), rows_per_block=rows_per_block)


def expected_entries(files: dict[str, list[str]]):
    """Plain line-by-line reading: (file, line number, message, details, gap)."""
    found = []
    for name, text in files.items():
        current = []
        for number, raw in enumerate(text, start=1):
            line = raw.strip()
            head = re.match(r"(\d{4}-\d\d-\d\d \d\d:\d\d:(\d\d)) \[.+?\] \[.+?\] \w+ (.*)", line)
            if head:
                current.append([name, number, head.group(3), [], int(head.group(2))])
            elif line and current:
                current[-1][3].append(line)
        for entry, after in zip(current, current[1:] + [None]):
            gap = None if after is None else float(after[4] - entry[4])
            found.append((entry[0], entry[1], entry[2], "\n".join(entry[3]), gap))
    return sorted(found, key=repr)


def entry_tuples(df):
    return rows(df.select("file", "pos", "message", "details", "time_diff_seconds"))


def test_entries_with_continuations(spark):
    text = [
        "orphan",
        HEAD.format(s=1, level="ERROR", text="boom"),
        "  first ",
        "\tsecond",
        "",
        HEAD.format(s=4, level="INFO", text="fine"),
    ]
    got = logs.assemble_entries(table_lines(spark, {"a": text}, 1000)).orderBy("pos").collect()
    assert [(r.pos, r.message, r.details, r.time_diff_seconds) for r in got] == [
        (2, "boom", "first\nsecond", 3.0),
        (6, "fine", "", None),
    ]
    assert got[0].log_level == "ERROR" and got[0].ip == "10.0.0.1" and got[0].username == "ann"
    assert (got[0].hour, got[0].minute, str(got[0].date)) == (10, 0, "2025-03-17")


def random_files(seed: int, files: int = 4, lines: int = 60) -> dict[str, list[str]]:
    rng = random.Random(seed)
    made = {}
    for f in range(files):
        text = []
        for i in range(rng.randrange(lines)):
            if rng.random() < 0.35:
                text.append(HEAD.format(s=rng.randrange(10), level=rng.choice(["INFO", "error"]), text=f"m{i}"))
            else:
                text.append(rng.choice(["", "  ", f" detail {i}\t"]))
        made[f"f{f}"] = text
    return made


@pytest.mark.parametrize("rows_per_block", [1, 2, 3, 7, 1000])
def test_entries_do_not_depend_on_the_block_size(spark, rows_per_block):
    files = random_files(rows_per_block)
    got = logs.assemble_entries(table_lines(spark, files, rows_per_block))
    assert entry_tuples(got) == expected_entries(files)


@pytest.mark.parametrize("split_bytes", ["200", "1000", "128m"])
def test_text_files_do_not_depend_on_the_split_size(spark, tmp_path, split_bytes):
    files = random_files(11, files=3, lines=400)
    for name, text in files.items():
        (tmp_path / f"{name}.log").write_text("\n".join(text) + ("\n" if text else ""))
    (tmp_path / "ignored.txt").write_text(HEAD.format(s=1, level="INFO", text="no"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        lines = read_log_lines(spark, str(tmp_path))
        if split_bytes == "200":
            assert lines.select("file", "block").distinct().count() > 20
        got = logs.assemble_entries(lines).withColumn("file", F.regexp_extract("file", r"(f\d)\.log$", 1))
        assert entry_tuples(got) == expected_entries(files)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_time_gaps_across_blocks(spark):
    files = random_files(23)
    heads = logs.header_entries(table_lines(spark, files, 3))
    got = rows(logs.time_gaps(heads).select("file", (F.col("ord") + 1).alias("pos"), "message", "time_diff_seconds"))
    assert got == sorted(((f, n, m, g) for f, n, m, _, g in expected_entries(files)), key=repr)


def test_backward_time_and_file_ends(spark):
    files = {"a": [HEAD.format(s=5, level="INFO", text="x"), HEAD.format(s=2, level="INFO", text="y")],
             "b": [HEAD.format(s=9, level="INFO", text="z")]}
    got = logs.time_gaps(logs.header_entries(table_lines(spark, files, 1)))
    assert rows(got.select("message", "time_diff_seconds")) == [("x", -3.0), ("y", None), ("z", None)]


def test_message_parts(spark):
    df = spark.createDataFrame([("fn (A.java:1) : hi",), ("plain text",)], "m string")
    m = F.col("m")
    got = df.select(logtext.function_name(m), logtext.file_info(m), logtext.clean_message(m)).collect()
    assert [tuple(r) for r in got] == [("fn", "A.java:1", "hi"), ("unknown", "", "plain text")]


def test_odd_headers(spark):
    text = [
        "\t" + HEAD.format(s=1, level="WARN", text="tabbed") + "  \r",
        "2025-13-45 99:99:99 [i] [u] INFO impossible date",
        "2025-03-17\t10:00:03   [i p]\t[ü]  Größe  näxt\u2028line",
        "2025-03-17 10:00:04 [i] [u] INFO",
    ]
    got = logs.assemble_entries(table_lines(spark, {"a": text}, 10)).orderBy("pos").collect()
    assert [(r.message, str(r.timestamp), r.details) for r in got] == [
        ("tabbed", "2025-03-17 10:00:01", ""),
        ("impossible date", "None", ""),
        ("näxt\u2028line", "2025-03-17 10:00:03", text[3]),
    ]
    assert (got[2].ip, got[2].username, got[2].log_level) == ("i p", "ü", "Größe")


def test_other_headers(spark):
    line = F.col("line")
    strict = spark.createDataFrame([(HEAD.format(s=1, level="INFO", text="fn (A.java:1) : hi "),)], "line string")
    got = strict.select(*logtext.header_fields(line, logtext.STRICT_HEADER, logtext.STRICT_FIELDS)).first()
    assert tuple(got)[1:] == ("10.0.0.1", "ann", "INFO", "fn", "A.java:1", "hi")
    component = spark.createDataFrame([("2025-03-17 10:00:01 INFO [core] up",), ("no",)], "line string")
    line = F.when(logtext.matches(line, logtext.COMPONENT_HEADER), line)
    got = component.select(*logtext.header_fields(line, logtext.COMPONENT_HEADER, logtext.COMPONENT_FIELDS)).collect()
    assert tuple(got[0])[1:] == ("INFO", "core", "up") and set(got[1]) == {None}


def test_summaries(spark):
    files = {"a": [HEAD.format(s=i, level=level, text="fn (A.java:1) : x") for i, level in enumerate(["ERROR", "error", "INFO"])]}
    entries = logs.time_gaps(logs.header_entries(table_lines(spark, files, 100)))
    assert rows(logs.level_counts(entries)) == [("error", "fn", 2), ("info", "fn", 1)]
    assert [tuple(r)[1:] for r in logs.hourly_summary(entries).collect()] == [(10, 3, 1.0, 1.0)]
    assert rows(logs.count_by(entries, "username")) == [("ann", 3)]
    stats = set(rows(logs.log_stats(entries)))
    assert stats == {
        ("total_logs", "", "3"), ("date_range", "min", "2025-03-17"), ("date_range", "max", "2025-03-17"),
        ("log_levels", "error", "2"), ("log_levels", "info", "1"), ("top_functions", "fn", "3"),
        ("top_usernames", "ann", "3"), ("top_ips", "10.0.0.1", "3"), ("avg_logs_per_hour", "", "3.000000"),
        ("max_logs_per_hour", "", "3"),
    }


def test_top_lists_and_all_levels(spark):
    rng = random.Random(1)
    made = [(f"L{i % 14}", f"u{rng.randrange(40)}") for i in range(400)]
    entries = spark.createDataFrame(made, "log_level string, username string").selectExpr(
        "*", "username AS function", "username AS ip", "DATE '2024-01-01' AS date", "1 AS hour"
    )
    stats = logs.log_stats(entries).collect()
    counts = Counter(u for _, u in made)
    best = sorted(counts, key=lambda u: (-counts[u], u))[:10]
    assert {r.key: r.value for r in stats if r.metric == "top_usernames"} == {u: str(counts[u]) for u in best}
    assert len([r for r in stats if r.metric == "log_levels"]) == 14
    assert [r.username for r in logs.top_by(entries, "username").collect()] == best


def test_unreadable_timestamps_count_but_have_no_hour(spark):
    files = {"a": [HEAD.format(s=1, level="INFO", text="x"), "2025-13-45 99:99:99 [i] [u] INFO y"]}
    stats = {(r.metric, r.key): r.value for r in logs.log_stats(logs.header_entries(table_lines(spark, files, 9))).collect()}
    assert stats[("total_logs", "")] == "2" and stats[("max_logs_per_hour", "")] == "1"


def test_format_detection_and_samples(spark):
    files = {"a": ["2024-01-01 10:00:00,123 INFO [x] y"] * 3 + ["z"] * 30, "b": ["2024-01-01T10:00:00.123Z INFO y"]}
    scores = {(r.file, r.pattern): (r.matches, r.lines) for r in logs.detect_format(table_lines(spark, files, 4)).collect()}
    assert scores[("a", "log4j")] == (3, 10) and scores[("a", "iso")] == (0, 10) and scores[("b", "iso")] == (1, 1)
    many = {"a": [HEAD.format(s=1, level="INFO" if i < 20 else "WARN", text=f"m{i}") for i in range(30)]}
    entries = logs.header_entries(table_lines(spark, many, 7))
    assert rows(logs.sample_distribution(entries)) == [("a", "component", "unknown", 20), ("a", "log_level", "INFO", 20)]


def test_new_files(spark, tmp_path):
    for name in ("a.log", "b.log", "c.txt"):
        (tmp_path / name).write_text("x")
    ledger = spark.createDataFrame([("a.log",)], "file_name string")
    fresh = logs.new_files(list_files(spark, str(tmp_path)), ledger).collect()
    assert [r.path.rsplit("/", 1)[-1] for r in fresh] == ["b.log"]


def test_one_big_file_is_spread_over_blocks(spark):
    """Window partitions over lines are bounded by the block, never by the file."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    lines = logs.lines_from_table(events.selectExpr("if(user_id >= 0, 'one', '') AS file", "event_id AS pos", "props AS line"))
    for df in (logs.assemble_entries(lines), logs.time_gaps(logs.header_entries(lines))):
        plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
        over_lines = [line for line in plan if "Exchange hashpartitioning(file" in line]
        assert over_lines and any("block" in line for line in over_lines)


def test_a_file_without_headers_has_no_entries_and_one_entry_keeps_a_long_tail(spark):
    n = 50_000
    plain = spark.range(n).select(F.lit("dump").alias("file"), F.col("id").alias("pos"), F.concat(F.lit("line "), "id").alias("line"))
    assert logs.assemble_entries(logs.lines_from_table(plain, rows_per_block=1000)).count() == 0
    head = HEAD.format(s=1, level="INFO", text="one")
    tailed = plain.withColumn("line", F.when(F.col("pos") == 500, F.lit(head)).otherwise(F.col("line")))
    (entry,) = logs.assemble_entries(logs.lines_from_table(tailed, rows_per_block=1000)).collect()
    assert entry.details.split("\n") == [f"line {i}" for i in range(501, n)]
