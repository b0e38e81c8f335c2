"""Near-duplicate texts by the Jaccard similarity of their word n-grams, with Bayesian pruning of candidates.

1. Scan: each text becomes its set of hashed n-grams, a MinHash signature and band keys. Texts with equal sets are one class.
2. Candidates: classes that share a band key meet in that key's bucket. Two signatures are compared a few values at a time;
   after m of n values agree, the similarity's posterior is Beta(m + 1, n - m + 1) under a uniform prior, and the pair is dropped
   once the posterior probability of reaching the threshold falls below a tolerance.
3. Components of what is left are clusters. A cluster's n-gram sets are brought together once, and all pairs that survive the
   same pruning are verified exactly.

Buckets and clusters are cut into blocks, and a task compares two blocks. It gives back a link count and one edge per class,
never the pairs, so a large group of near copies costs comparisons but no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import groups, mixed, scan_words, stored, utf8, whole_rows
from llm.components import components, local_roots

NGRAM = 5
THRESHOLD = 0.8
#: 32 bands of 5 values miss a pair at the threshold with a probability of 3 in a million.
BANDS, BAND_ROWS = 32, 5
VALUES = BANDS * BAND_ROWS
TOLERANCE = 1e-6
STEP = 16
BLOCK = 1024
ROWS_PER_TASK = 20_000
SET_BYTES_PER_TASK = 6 << 20
SET_BLOCK = 512
LEAST_TASKS = 32

_rng = np.random.default_rng(20_240_501)
_MUL = (_rng.integers(0, 1 << 32, VALUES, dtype=np.uint32) | np.uint32(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint32)


def least_matches(threshold: float, tolerance: float, step: int = STEP) -> list[tuple[int, int]]:
    """(n, m): after n values, fewer than m agreements leave P(similarity >= threshold) below the tolerance.

    With a uniform prior that probability is P(Binomial(n + 1, threshold) <= agreements).
    """
    out = []
    for n in [*range(step, VALUES, step), VALUES]:
        total, m = 0.0, 0
        while total + (p := math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)) < tolerance:
            total, m = total + p, m + 1
        out.append((n, m))
    return out


def ngram_sets(data: np.ndarray, offsets: np.ndarray, width: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct word n-grams of each text, sorted; a text of fewer words, but not none, is one n-gram."""
    words = scan_words(data, offsets)
    sizes = np.bincount(words.row, minlength=len(offsets) - 1)
    whole = words.whole(width)
    rows, hashes = [words.row[: len(whole)][whole]], [words.window_hash(width)[whole]]
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for n in range(1, width):
        short = np.flatnonzero(sizes == n)
        if len(short):
            rows.append(short)
            hashes.append(words.window_hash(n)[first[short]])
    row, h = np.concatenate(rows).astype(np.int64), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def signatures(row: np.ndarray, h: np.ndarray, n_rows: int) -> np.ndarray:
    """MinHash values of the sets of rows 0 to n_rows - 1, none of which is empty: one uint32 column for each hash function."""
    starts = np.searchsorted(row, np.arange(n_rows))
    x = (mixed(h) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((n_rows, VALUES), np.uint32)
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat(x * _MUL[k] + _ADD[k], starts)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    out = np.empty((len(sig), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(sig), b + 1, np.uint64)
        for k in range(b * BAND_ROWS, (b + 1) * BAND_ROWS):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, k])
        out[:, b] = key
    return out


def _scan(texts: DataFrame, width: int) -> DataFrame:
    """(id, text_md5, digest, sig, bands) of each row; digest, sig and bands are null for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = utf8(batch.column(2))
            digests, sigs, bands = [], [], []
            for a, b in groups(offsets):
                row, h = ngram_sets(data, offsets[a : b + 1], width)
                own, at = np.unique(row, return_index=True)
                sig = signatures(np.repeat(np.arange(len(own)), np.diff([*at, len(row)])), h, len(own)) if len(own) else np.zeros((0, VALUES), np.uint32)
                keys, brief = band_keys(sig).astype(np.int64), sig.astype(np.uint16)
                place = np.full(b - a, -1)
                place[own] = np.arange(len(own))
                ends = [*at[1:], len(row)]
                for p in place.tolist():
                    digests.append(None if p < 0 else hashlib.blake2b(h[at[p] : ends[p]].tobytes(), digest_size=16).digest())
                    sigs.append(None if p < 0 else brief[p].tobytes())
                    bands.append(None if p < 0 else keys[p])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["id", "text_md5", "digest", "sig", "bands"],
            )

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, text_md5 string, digest binary, sig binary, bands array<long>")


def _prune(sig: np.ndarray, i: np.ndarray, j: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Which of the pairs survive the incremental comparison of their signatures."""
    alive, agreed, done = np.arange(len(i)), np.zeros(len(i), np.int32), 0
    for n, least in bounds:
        agreed = agreed + (sig[i[alive], done:n] == sig[j[alive], done:n]).sum(1, dtype=np.int32)
        keep = agreed >= least
        alive, agreed, done = alive[keep], agreed[keep], n
    return alive


def _pairs(p: np.ndarray, q: np.ndarray, same: bool, most: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of p and q, or those within p, in pieces of about `most`."""
    step = max(1, most // max(len(q), 1))
    for a in range(0, len(p), step):
        i, j = np.repeat(p[a : a + step], len(q)), np.tile(q, len(p[a : a + step]))
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        yield i, j


def _segments(table: pa.Table, keys: list[str]) -> Iterator[pa.Table]:
    """The parts of a table with equal keys."""
    table = table.combine_chunks().sort_by([(k, "ascending") for k in [*keys, "uid"]])
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        v = np.asarray(table[k])
        new[1:] |= v[1:] != v[:-1]
    at = np.flatnonzero(new)
    for a, b in zip(at, [*at[1:], table.num_rows], strict=True):
        yield table.slice(a, b - a)


def _sides(part: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    upper = np.asarray(part["upper"])
    if part["lo"][0].as_py() == part["hi"][0].as_py():
        every = np.arange(part.num_rows)
        return every, every, True
    return np.flatnonzero(~upper), np.flatnonzero(upper), False


def _sig_matrix(part: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(part["sig"].to_pylist()), np.uint16).reshape(part.num_rows, VALUES)


def _in_blocks(df: DataFrame, key: str, size: str, block: int) -> DataFrame:
    """Rows of a key, dealt to pairs of blocks (lo, hi); `size` is the key's number of rows."""
    df = df.withColumn("blocks", F.ceil(F.col(size) / block).cast("int")).withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return df.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other"), "upper": F.col("block") > F.col("other")}).drop("blocks", "block", "other")


def candidate_edges(classes: DataFrame, bounds: list[tuple[int, int]], block: int = BLOCK, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(a, b) edges that connect, bucket by bucket, all classes whose signatures survive the pruning."""
    bands = classes.select("uid", F.explode("bands").alias("band"))
    sizes = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(bands.join(sizes, "band"), "buckets")
    dealt = _in_blocks(met.join(classes.select("uid", "sig"), "uid"), "band", "n", block)
    tasks = max(LEAST_TASKS, -(-met.count() // rows_per_task))
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("band", "lo", "hi"), F.lit(tasks)))

    def compare(table: pa.Table) -> pa.Table:
        out_a, out_b = [], []
        for part in _segments(table, ["band", "lo", "hi"]):
            p, q, same = _sides(part)
            if not len(p) or not len(q):
                continue
            sig, uid = _sig_matrix(part), np.asarray(part["uid"])
            # Rows close to the first are one group by that alone; only pairs with another row are left.
            rest = np.arange(1, len(uid))
            close = rest[_prune(sig, np.zeros(len(rest), np.int64), rest, bounds)]
            near = np.zeros(len(uid), bool)
            near[[0, *close]] = True
            left, right = [np.zeros(len(close), np.int64)], [close]
            jobs = [(p[~near[p]], q, False)] if same else [(p[~near[p]], q, False), (p[near[p]], q[~near[q]], False)]
            for x, y, _ in jobs:
                for i, j in _pairs(x, y, False):
                    i, j = (i[i != j], j[i != j]) if same else (i, j)
                    alive = _prune(sig, i, j, bounds)
                    left.append(i[alive])
                    right.append(j[alive])
            root = local_roots(np.concatenate(left), np.concatenate(right), len(uid))
            some = root != np.arange(len(uid))
            out_a.append(uid[some])
            out_b.append(uid[root[some]])
        empty = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([empty, *out_a]), "b": np.concatenate([empty, *out_b])})

    return dealt.groupBy("task").applyInArrow(compare, "a long, b long")


def _overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets: one by one if pairs are few, else by products of 0/1 matrices."""
    rows = np.unique(np.concatenate([i, j]))
    if len(i) <= 8 * len(rows):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    place = np.full(len(sets), -1)
    place[rows] = np.arange(len(rows))
    flat, own = np.concatenate([sets[r] for r in rows]), np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    value, back, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1  # n-grams of one set are in no intersection
    column = np.cumsum(shared) - 1
    keep = shared[back]
    own, back = own[keep], column[back[keep]]
    order = np.argsort(back, kind="stable")
    own, back = own[order], back[order]
    total = np.zeros((len(rows), len(rows)), np.float32)
    width = 4096
    edges = np.searchsorted(back, np.arange(0, int(shared.sum()) + width, width))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        m = np.zeros((len(rows), width), np.float32)
        m[own[a:b], back[a:b] - k * width] = 1
        total += m @ m.T
    return total[place[i], place[j]].astype(np.int64)


def verified_links(members: DataFrame, bounds: list[tuple[int, int]], threshold: float, block: int, tasks: int) -> DataFrame:
    """(uid, n, root) parts for rows (uid, label, size, sig, grams, members): n sums members of linked classes, root is one of them."""
    dealt = _in_blocks(members, "label", "size", block)
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("label", "lo", "hi"), F.lit(tasks)))

    def verify(table: pa.Table) -> pa.Table:
        uids, ns, roots = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for part in _segments(table, ["label", "lo", "hi"]):
            p, q, same = _sides(part)
            if not len(p) or not len(q):
                continue
            sig, uid, weight = _sig_matrix(part), np.asarray(part["uid"]), np.asarray(part["members"])
            sets = [np.frombuffer(g, np.uint64) for g in part["grams"].to_pylist()]
            size = np.array([len(s) for s in sets])
            left, right = [], []
            for i, j in _pairs(p, q, same):
                alive = _prune(sig, i, j, bounds)
                left.append(i[alive])
                right.append(j[alive])
            i, j = np.concatenate(left), np.concatenate(right)
            if not len(i):
                continue
            both = _overlaps(sets, i, j)
            linked = both >= threshold * (size[i] + size[j] - both) - 1e-9
            i, j = i[linked], j[linked]
            n = np.bincount(i, weight[j], len(uid)) + np.bincount(j, weight[i], len(uid))
            root, some = local_roots(i, j, len(uid)), n > 0
            uids.append(uid[some])
            ns.append(n[some].astype(np.int64))
            roots.append(uid[root[some]])
        return pa.table({"uid": np.concatenate(uids), "n": np.concatenate(ns), "root": np.concatenate(roots)})

    return dealt.groupBy("task").applyInArrow(verify, "uid long, n long, root long")


def _grams(texts: DataFrame, width: int) -> DataFrame:
    """(digest, uid, grams) of rows (digest, uid, text) whose set has that digest; grams are sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = utf8(batch.column(2))
            wanted, uids = batch.column(0).to_pylist(), np.asarray(batch.column(1))
            for a, b in groups(offsets):
                row, h = ngram_sets(data, offsets[a : b + 1], width)
                at = np.searchsorted(row, np.arange(b - a + 1))
                own = [h[at[k] : at[k + 1]].tobytes() for k in range(b - a)]
                ok = [k for k, g in enumerate(own) if hashlib.blake2b(g, digest_size=16).digest() == wanted[a + k]]
                yield pa.RecordBatch.from_arrays([pa.array(uids[a:b][ok]), pa.array([own[k] for k in ok], pa.binary())], ["uid", "grams"])

    return texts.mapInArrow(run, "uid long, grams binary")


def _linked(docs: DataFrame, doc_id: str, text: str, width: int, threshold: float, tolerance: float, block: int) -> DataFrame:
    """(id, text_md5, label, n_links) of each row of docs; label is null for texts without words."""
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.md5(F.col(f"`{text}`").cast("binary")).alias("text_md5"), F.col(f"`{text}`").alias("text"))
    scanned = stored(_scan(texts, width), "signatures")
    bounds = least_matches(threshold, tolerance)
    # digest decides sig and bands, which are grouped along
    classes = scanned.where("digest IS NOT NULL").groupBy("digest", "sig").agg(F.count("*").alias("members"), F.min(F.struct("id", "text_md5")).alias("rep"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("uid", F.monotonically_increasing_id()), "classes")
    clusters = components(candidate_edges(classes, bounds, block)).withColumnRenamed("node", "uid")
    sizes = clusters.groupBy("label").agg(F.count("*").alias("size"))
    clusters = stored(clusters.join(sizes, "label").join(classes.drop("bands"), "uid"), "clusters")
    wanted = clusters.select(F.col("rep.id").alias("rep_id"), F.col("rep.text_md5").alias("rep_md5"), "digest", "uid")
    same = F.col("id").eqNullSafe(F.col("rep_id")) & F.col("text_md5").eqNullSafe(F.col("rep_md5"))
    grams = _grams(texts.join(wanted, same).select("digest", "uid", "text"), width).groupBy("uid").agg(F.min("grams").alias("grams"))
    members = stored(clusters.select("uid", "label", "size", "sig", "members").join(grams, "uid"), "cluster-sets")
    volume = members.agg(F.sum(F.length("grams") * F.ceil(F.col("size") / SET_BLOCK))).first()[0] or 0
    links = stored(verified_links(members, bounds, threshold, min(block, SET_BLOCK), max(LEAST_TASKS, -(-int(volume) // SET_BYTES_PER_TASK))), "jaccard-links")
    counts = links.groupBy("uid").agg(F.sum("n").alias("n"))
    final = components(links.select(F.col("uid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "uid")
    named = classes.select("digest", "uid", "members", "rep").join(counts, "uid", "left").join(final, "uid", "left")
    named = named.select("digest", F.coalesce("label", "uid").alias("label"), (F.coalesce("n", F.lit(0)) + F.col("members") - 1).alias("n_links"), "rep")
    reps = named.groupBy("label").agg(F.min("rep").alias("group_rep"))
    named = stored(named.drop("rep").join(reps, "label"), "jaccard-groups")
    return scanned.select("id", "text_md5", "digest").join(named, "digest", "left")


def jaccard_links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = NGRAM, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """One row per row of docs: doc_id, class_id, n_links.

    Two rows link if the sets of their word n-grams have a Jaccard similarity >= threshold. n_links counts the other rows linked
    directly, copies included; class_id is the least doc_id reachable over links. Null texts and texts without words link with
    nothing and are classes of their own. Rows that repeat a doc_id are rows of their own; a null doc_id counts as less
    than any other. Other columns of docs are not read.
    """
    out = _linked(docs, doc_id, text, width, threshold, tolerance, block)
    alone = F.col("digest").isNull()
    return out.select(F.col("id").alias("doc_id"), F.when(alone, F.col("id")).otherwise(F.col("group_rep.id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = NGRAM, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """docs with one row of each group of linked rows, that of the least doc_id; columns stay.

    Rows without words all stay. Of repeated rows with one id and text, one stays.
    """
    found = _linked(docs, doc_id, text, width, threshold, tolerance, block)
    reps = found.where("digest IS NOT NULL").select(F.col("group_rep.id").alias("id"), F.col("group_rep.text_md5").alias("md5")).distinct()
    wordless = found.where("digest IS NULL").select("id", F.col("text_md5").alias("md5")).distinct()
    kept = stored(reps.withColumn("every", F.lit(False)).union(wordless.withColumn("every", F.lit(True))), "kept-rows")
    rows = whole_rows(docs, F.col(f"`{doc_id}`").alias("own_id"), F.md5(F.col(f"`{text}`").cast("binary")).alias("own_md5"))
    same = F.col("own_id").eqNullSafe(F.col("id")) & F.col("own_md5").eqNullSafe(F.col("md5"))
    # Wordless rows all stay, so only the others are numbered.
    one = rows.join(kept.where("NOT every"), same).selectExpr("row", "row_number() OVER (PARTITION BY id, md5 ORDER BY md5) AS number").where("number = 1")
    return one.select("row.*").union(rows.join(kept.where("every"), same).select("row.*"))


LINKS_SQL = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + {NGRAM} - 1], ' ') AS gram
  FROM worded, unnest(range(1, greatest(len(w) - {NGRAM} + 1, 1) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS together FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE together >= {THRESHOLD} * (x.n + y.n - together) - 1e-9
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT doc_id, least(doc_id, coalesce(b, doc_id)) AS class_id, coalesce(n, 0) AS n_links
FROM documents LEFT JOIN least l ON doc_id = l.a LEFT JOIN counts c ON doc_id = c.a
"""
