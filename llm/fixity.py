"""Merkle fixity audit of the replicas of a WARC archive.

Pages are the archive's records, laid one after the other in the order of their ids; a record is known by its byte offset. Each
replica's records are hashed, and hashes are summed up a tree: a leaf is a range of LEAF_BYTES of offsets, a node above it
FANOUT ranges. A level is one grouped aggregate over the level below. Ranges are by offset, not by count, so a record that a
replica lost or gained changes its own branch alone.

The audit compares the replicas' roots and goes down by joins, only into branches that differ, to the records of differing
leaves. There, the hash that most replicas hold is expected, and each replica that holds another is reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import parts_for, stored

LEAF_BYTES = 1 << 16
FANOUT = 16
RECORDS_PER_PARTITION = 200_000
REPLICAS = ("a", "b", "c")
#: Page ids modulo this choose the records that `damaged` changes.
DAMAGE_EVERY = 101


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The page as a WARC record. Nulls are written as empty."""
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in (page_id, url, html)]
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: "), text[0], F.lit("\r\nWARC-Target-URI: "), text[1],
        F.lit("\r\nContent-Length: "), F.octet_length(text[2]).cast("string"), F.lit("\r\n\r\n"), text[2], F.lit("\r\n\r\n"),
    )


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def damaged(page_id: Column, text: Column) -> dict[str, Column]:
    """Each replica's copy of a record, null if it lost it: the given tables hold no replicas, so damage is planted by page id.

    Replica b has a flipped bit in some records and only half of others, c lost some; in some, b and c are damaged in different ways.
    """
    k = F.coalesce(F.pmod(page_id, F.lit(DAMAGE_EVERY)), F.lit(-1))
    flipped = F.concat(F.lit("w"), F.substring(text, 2, 2**31 - 1))
    half = F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))
    return {
        "a": text,
        "b": F.when(k.isin(7, 19), flipped).when(k == 11, half).otherwise(text),
        "c": F.when(k == 13, F.lit(None)).when(k == 19, half).otherwise(text),
    }


def placed(rows: DataFrame, order: list[str], n_bytes: str = "n_bytes") -> DataFrame:
    """rows with record_offset, the sum of n_bytes of all rows before in the order given.

    Ranges of the order are summed each in its own task; the driver sees one row per range.
    """
    parts = parts_for(rows.count(), RECORDS_PER_PARTITION)
    at, names = rows.columns.index(n_bytes), [*rows.columns, "__part", "__start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = np.asarray(batch.column(at)).astype(np.int64)
            ends = start + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(sizes), part, np.int32)), pa.array(ends - sizes)], names)
            start = int(ends[-1]) if len(ends) else start

    schema = T.StructType([*rows.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__start", T.LongType())])
    ranged = stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, schema), "record-ranges")
    totals = sorted(ranged.groupBy("__part").agg(F.sum(n_bytes).alias("n")).collect())  # one row per range
    before = np.concatenate([[0], np.cumsum([r.n for r in totals])]).astype(int).tolist()
    bases = rows.sparkSession.createDataFrame([(r["__part"], b) for r, b in zip(totals, before, strict=False)], "__part int, __base long")
    return ranged.join(F.broadcast(bases), "__part").withColumn("record_offset", F.col("__base") + F.col("__start")).drop("__part", "__start", "__base")


def _summed(rows: DataFrame, range_of: Column, key: str) -> DataFrame:
    """(replica, node, digest): the hash over the sorted (key, digest) of each node's range."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), F.col("digest").alias("d")))), lambda x: F.concat_ws(":", x.k.cast("string"), F.hex(x.d)))
    return rows.groupBy("replica", range_of.alias("node")).agg(digest(F.array_join(parts, ",")).alias("digest"))


def tree(copies: DataFrame, leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels (replica, node, digest) from the leaves to the roots, whose node is 0."""
    levels = [stored(_summed(copies, F.expr(f"record_offset div {leaf_bytes}"), "record_offset"), "merkle")]
    top = levels[0].agg(F.max("node")).first()[0] or 0
    while top:
        levels.append(stored(_summed(levels[-1], F.expr(f"node div {fanout}"), "node"), "merkle"))
        top //= fanout
    return levels


def differing(level: DataFrame, n_replicas: int) -> DataFrame:
    """Nodes of a level that not all replicas hold alike."""
    return level.groupBy("node").agg(F.count("*").alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi")).where((F.col("n") < n_replicas) | (F.col("lo") != F.col("hi"))).select("node")


def suspects(copies: DataFrame, levels: list[DataFrame], n_replicas: int, leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT) -> DataFrame:
    """The copies in leaves that differ, found from the roots down."""
    bad = differing(levels[-1], n_replicas)
    for level in reversed(levels[:-1]):
        below = level.join(bad.withColumnRenamed("node", "up"), F.expr(f"node div {fanout}") == F.col("up"), "left_semi")
        bad = differing(below, n_replicas)
    return copies.join(bad, F.expr(f"record_offset div {leaf_bytes}") == F.col("node"), "left_semi")


def audit(copies: DataFrame, replicas: tuple[str, ...] = REPLICAS, leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT) -> DataFrame:
    """One row per record and replica that is not as it should be: record_offset, page_id, replica, state, found, expected.

    copies has a row for each record that a replica holds: replica, record_offset, page_id, digest. state is corrupt (another hash
    than most replicas hold), missing (most hold the record), extra (most don't), or undecided, for all replicas, if no hash nor
    absence has more than half of them. found and expected are hex, null for absence. replicas names all, so that an empty one
    counts. A record that a replica holds several times at one offset counts as one, with a hash over these. Offsets must not be null.
    """
    n = len(replicas)
    rows = suspects(copies, tree(copies, leaf_bytes, fanout), n, leaf_bytes, fanout)
    own = F.sort_array(F.collect_list("digest"))
    once = rows.groupBy("record_offset", "replica").agg(F.max("page_id").alias("page_id"), own.alias("own"))
    once = once.withColumn("digest", F.when(F.size("own") == 1, F.lower(F.hex(F.get("own", F.lit(0))))).otherwise(F.sha2(F.array_join(F.transform("own", F.hex), ","), 256)))
    held = once.groupBy("record_offset").agg(F.max("page_id").alias("page_id"), *[F.max(F.when(F.col("replica") == r, F.col("digest"))).alias(f"__{k}") for k, r in enumerate(replicas)])
    digests = [F.col(f"__{k}") for k in range(n)]
    votes = [sum((d.eqNullSafe(e).cast("int") for e in digests), F.lit(0)) for d in digests]
    wins = [v * 2 > n for v in votes]
    decided = F.greatest(*wins) if n > 1 else wins[0]
    expected = F.coalesce(*[F.when(w, d) for w, d in zip(wins, digests, strict=True)])
    listed = F.explode(F.array(*[F.struct(F.lit(r).alias("replica"), d.alias("found")) for r, d in zip(replicas, digests, strict=True)]))
    out = held.select("record_offset", "page_id", decided.alias("decided"), expected.alias("expected"), listed.alias("c")).where(~F.col("decided") | ~F.col("c.found").eqNullSafe(F.col("expected")))
    state = F.when(~F.col("decided"), "undecided").when(F.col("c.found").isNull(), "missing").when(F.col("expected").isNull(), "extra").otherwise("corrupt")
    return out.select("record_offset", "page_id", "c.replica", state.alias("state"), F.col("c.found").alias("found"), "expected")


def page_copies(pages: DataFrame) -> DataFrame:
    """The replicas' records (replica, record_offset, page_id, digest) of all pages, with the planted damage.

    Every page is a record, also one with nulls or a repeated id; records with equal ids are in the order of their hashes.
    """
    text = record(F.col("page_id"), F.col("url"), F.col("html"))
    held = [F.struct(F.lit(r).alias("replica"), digest(c).alias("digest")) for r, c in damaged(F.col("page_id"), F.col("record")).items()]
    slim = pages.select("page_id", text.alias("record")).select("page_id", F.octet_length("record").cast("long").alias("n_bytes"), digest(F.col("record")).alias("whole"), *[h.alias(f"copy{k}") for k, h in enumerate(held)])
    rows = placed(stored(slim, "records"), ["page_id", "whole"])
    copies = rows.select("record_offset", "page_id", F.explode(F.array(*[F.col(f"copy{k}") for k in range(len(held))])).alias("c"))
    return stored(copies.select("c.replica", "record_offset", "page_id", "c.digest").where("digest IS NOT NULL"), "copies")


def audit_pages(pages: DataFrame) -> DataFrame:
    """The audit of three replicas of the archive of all pages.

    Nulls in a page read as nothing, except that a page without an id is a record like others. Records of any length are hashed whole.
    Repeated pages are records of their own; an empty table has an empty archive, and no row to report.
    """
    return audit(page_copies(pages))


AUDIT_SQL = f"""
WITH records AS (
  SELECT page_id, concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Record-ID: ', page_id, chr(13), chr(10),
    'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Length: ', strlen(coalesce(html, '')), chr(13), chr(10), chr(13), chr(10),
    html, chr(13), chr(10), chr(13), chr(10)) AS r FROM pages
), placed AS (
  SELECT page_id, r, coalesce(((page_id % {DAMAGE_EVERY}) + {DAMAGE_EVERY}) % {DAMAGE_EVERY}, -1) AS k,
    CAST(sum(strlen(r)) OVER (ORDER BY page_id NULLS FIRST, sha256(r) ROWS UNBOUNDED PRECEDING) - strlen(r) AS BIGINT) AS record_offset FROM records
), held AS (
  SELECT record_offset, page_id, 'a' AS replica, sha256(r) AS found FROM placed
  UNION ALL SELECT record_offset, page_id, 'b', sha256(CASE WHEN k IN (7, 19) THEN 'w' || substring(r, 2) WHEN k = 11 THEN left(r, length(r) // 2) ELSE r END) FROM placed
  UNION ALL SELECT record_offset, page_id, 'c', CASE WHEN k = 13 THEN NULL ELSE sha256(CASE WHEN k = 19 THEN left(r, length(r) // 2) ELSE r END) END FROM placed
), most AS (
  SELECT record_offset, found AS expected FROM held GROUP BY record_offset, found HAVING count(*) * 2 > 3
)
SELECT h.record_offset, page_id, replica,
  CASE WHEN m.record_offset IS NULL THEN 'undecided' WHEN found IS NULL THEN 'missing' ELSE 'corrupt' END AS state, found, expected
FROM held h LEFT JOIN most m ON h.record_offset = m.record_offset
WHERE m.record_offset IS NULL OR found IS DISTINCT FROM expected
"""
