import duckdb
import pandas as pd
from pyspark.sql import functions as F

from llm import line_dedup
from llm.queries import ORACLES, QUERIES


def expected(rows, ratio, least):
    pages, lines = {}, {}
    for host, text in rows:
        if host is not None:
            pages[host] = pages.get(host, 0) + 1
            for line in {x.strip(line_dedup.BLANKS) for x in (text or "").split("\n")} - {""}:
                lines[host, line] = lines.get((host, line), 0) + 1
    gone = {k for k, n in lines.items() if n >= least and n > ratio * pages[k[0]]}
    return [text if text is None else "\n".join(x for x in text.split("\n") if (host, x.strip(line_dedup.BLANKS)) not in gone) for host, text in rows]


def test_documents_match_brute_force_and_rows_stay(docs):
    rows = docs.collect()
    for ratio, least in ((0.1, 2), (0.5, 1), (2.0, 1)):
        out = line_dedup.dedup_documents(docs, max_ratio=ratio, min_pages=least)
        assert out.columns == docs.columns
        want = expected([(r.source, r.text) for r in rows], ratio, least)
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(((r.doc_id, t) for r, t in zip(rows, want, strict=True)), key=repr)


def test_large_lists_go_by_shuffle_with_equal_results(docs, monkeypatch):
    small = line_dedup.dedup_documents(docs, max_ratio=0.1, min_pages=1).collect()
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    assert sorted(line_dedup.dedup_documents(docs, max_ratio=0.1, min_pages=1).collect(), key=repr) == sorted(small, key=repr)


def test_no_site_no_boilerplate_and_names_clash(spark, no_docs):
    rows = [(None, "a\nb", 1)] * 6 + [("h", "a\nb", 2)] * 5 + [("h", None, 3), ("h", "", 3)]
    frame = spark.createDataFrame(rows, "source string, text string, n_lines long")
    out = line_dedup.split_boilerplate(frame, F.col("source"), F.split("text", "\n"))
    got = sorted((r.source or "", r.n_lines, r.n_dropped) for r in out.collect())
    assert got == [("", 2, 0)] * 6 + [("h", 0, 0)] * 2 + [("h", 2, 2)] * 5
    assert line_dedup.dedup_documents(no_docs).count() == 0


def test_small_hosts_go_by_the_ratio(spark):
    rows = [("four", f"menu\nonly {i}") for i in range(4)] + [("two", "menu \t\n\ta"), ("two", "\tmenu\r\nb")] + [("one", "menu\nx")] + [("big", "rare" if i < 3 else f"y{i}") for i in range(40)]
    got = line_dedup.dedup_documents(spark.createDataFrame(rows, "source string, text string")).collect()
    assert sorted(tuple(r) for r in got) == sorted((h, t.split("\n")[-1] if h in ("four", "two") else t) for h, t in rows)


def test_rows_stay_as_they_were(docs):
    named = docs.selectExpr("*", "77L AS n_lines", "55L AS n_dropped", "'k' AS kept_lines", "1 AS __host", "source AS host", "2 AS row")
    out = line_dedup.dedup_documents(named, min_pages=2)
    assert out.columns == named.columns
    other = [c for c in named.columns if c not in ("text", "n_chars")]
    assert sorted(map(repr, out.select(*other).collect())) == sorted(map(repr, named.select(*other).collect()))


def test_hosts(spark):
    urls = {"http://user:pw@Big.org/": "big.org", "https://a@b@c.de:80/x@y": "c.de", "http://[::1]:8/": "[::1]", "https://x.y?q=a@b": "x.y", "nohost": None, "http:///p": None, None: None}
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url: r.host for r in frame.select("url", line_dedup.url_host(F.col("url")).alias("host")).collect()} == urls


def test_pages_match_sql(spark):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet' UNION ALL VALUES (NULL, NULL, NULL), (-1, 'https://A.b/x', ''), (-2, 'nohost', '<p>x</p>'), (-3, 'https://u:p@a.b/y', '<p>x' || chr(9) || '</p>')")
    mine = QUERIES["op3_line_dedup"](spark, sf).toPandas()
    extra = spark.createDataFrame([(None, None, None), (-1, "https://A.b/x", ""), (-2, "nohost", "<p>x</p>"), (-3, "https://u:p@a.b/y", "<p>x\t</p>")], "page_id long, url string, html string")
    more = line_dedup.dedup_pages(spark.read.parquet(f"{sf}/pages.parquet").union(extra)).toPandas()
    want = db.execute(ORACLES["op3_line_dedup"]).df()
    order = lambda d: d[sorted(d.columns)].sort_values(["page_id", "text"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(more), order(want), check_dtype=False)
    assert len(mine) + 4 == len(more)
