import random

from pyspark.sql import functions as F

from llm import line_dedup

OLD_UNSEEN = r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->"


def test_quick_patterns_find_what_the_plain_ones_find(spark):
    """Whole and broken tags, names that begin alike, comments across lines."""
    names = line_dedup.BREAKS.split("(")[1].split(")")[0].split("|") + "a b i em hea h7 t tab u script style para divx".split()
    rng = random.Random(4)
    made = [f"{a}{n}{b}" for n in names for a in ("<", "</", "< ") for b in (">", "/>", " x='1'>", "\n>", "", " ", "-x>")]
    made += ["<!--", "-->", "<!-- a\n -->", "<script>", "</script>", "<style>", "</style>", "text", "<", ">", "\n"]
    texts = ["".join(rng.choices(made, k=12)) for _ in range(3000)] + made
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    pairs = [(line_dedup.BREAKS, line_dedup.QUICK_BREAKS), (OLD_UNSEEN, line_dedup.UNSEEN)]
    for plain, quick in pairs:
        assert df.where(F.regexp_replace("t", plain, "#") != F.regexp_replace("t", quick, "#")).count() == 0
    assert df.where(F.regexp_replace("t", line_dedup.BREAKS, "#") != F.col("t")).count() > 500


def test_the_search_begins_at_tags_only():
    """A choice of whole patterns is tried at every character; a common first one is searched for."""
    for pattern in (line_dedup.UNSEEN, line_dedup.QUICK_BREAKS):
        assert pattern.removeprefix("(?s)").startswith("<") and "|" not in pattern.split("(?:", 1)[0]


def test_null_and_repeated_lines(spark):
    pages = spark.createDataFrame([("h", ["a ", "a", None, "", " "]), ("h", ["a", "b"]), ("h", None)], "host string, lines array<string>")
    got = line_dedup.boilerplate(pages, F.col("host"), F.col("lines")).collect()
    assert [(r.host, len(r["drop"])) for r in got] == [("h", 1)]
