import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from check_queries import normalised
from llm import fixity
from llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COPIES = "replica string, record_offset long, page_id long, digest binary"


def test_all_operators_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES if q != "pipeline"}


@pytest.mark.parametrize(("leaf", "fanout"), [(64, 2), (1 << 16, 16), (1000, 3)])
def test_damage_of_every_kind_is_found_and_nothing_else(spark, leaf, fanout):
    sha = lambda x: hashlib.sha256(x.encode()).digest()
    held = {r: {i * 37: (i, sha(f"record {i}")) for i in range(500)} for r in "abc"}
    held["b"][37 * 3] = (3, sha("flipped"))
    del held["c"][37 * 250]
    held["a"][37 * 499 + 5] = (900, sha("extra"))
    held["a"][0], held["b"][0] = (0, sha("x")), (0, sha("y"))
    frame = spark.createDataFrame([(r, at, i, d) for r, own in held.items() for at, (i, d) in own.items()], COPIES).repartition(4)
    got = sorted((r.page_id, r.replica, r.state) for r in fixity.audit(frame, leaf_bytes=leaf, fanout=fanout).collect())
    assert got == [(0, "a", "undecided"), (0, "b", "undecided"), (0, "c", "undecided"), (3, "b", "corrupt"), (250, "c", "missing"), (900, "a", "extra")]
    levels = fixity.tree(frame, leaf, fanout)
    assert levels[-1].count() == 3 and levels[-1].select("digest").distinct().count() == 3
    read = fixity.suspects(frame, levels, 3, leaf, fanout)
    assert leaf > 10_000 or read.count() < 0.5 * frame.count()


def test_equal_replicas_and_lost_ones(spark):
    rows = [(r, i * 10, i, bytes([i])) for r in "abc" for i in range(50)]
    assert fixity.audit(spark.createDataFrame(rows, COPIES), leaf_bytes=40, fanout=2).count() == 0
    two = spark.createDataFrame([r for r in rows if r[0] != "c"], COPIES)
    assert {(r.replica, r.state) for r in fixity.audit(two, leaf_bytes=40, fanout=2).collect()} == {("c", "missing")}
    assert fixity.audit(two.limit(0)).count() == 0


def test_pages_match_sql_with_awkward_rows_in_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(fixity, "RECORDS_PER_PARTITION", 17)
    extra = "VALUES (NULL, NULL, NULL), (NULL, 'u', 'é'), (7, 'u', 'é🙂'), (7, 'u', 'same'), (7, 'u', 'same'), (-94, '', ''), (13, NULL, 'x')"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT page_id, url, html FROM '{SF}/pages.parquet' UNION ALL {extra}")
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").union(spark.sql(f"SELECT * FROM {extra}"))
    mine, want = fixity.audit_pages(pages), db.execute(ORACLES["op2_warc_fixity"]).df()
    assert len(want) > 0 and normalised(mine.toPandas()) == normalised(want)
    copies = fixity.page_copies(pages)
    assert copies.where(F.col("replica") == "a").count() == pages.count()
