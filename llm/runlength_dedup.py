"""Exact dedup of repeated byte strings, by run-length compressed suffix indexes over what may repeat.

A string of `width` bytes that occurs twice holds the same *anchor* both times: the least-hashed k-byte string inside it. So
the strings that start in a text fall into runs with a common anchor, about one for 40 bytes, and only runs with equal anchors
can hold equal strings.

1. Anchors: each run becomes a small record, dealt by its anchor. Runs that are equal as a whole are settled by order
   alone: the first stays, the others are repeats. Runs of an anchor that no other run shares repeat nothing.
2. Left are different runs with one anchor: edges of copies, and passages between other texts. Their bytes are fetched once and dealt
   by anchor into shards of bounded size.
3. A shard's runs, in document order, are indexed: suffix order, Burrows-Wheeler transform, its runs. Matching lengths are computed
   at the sampled run ends alone, and streamed to all other positions: where the transform repeats a symbol, the length to the
   preceding suffix is that of the position before less one. Positions that match over `width` bytes form intervals, of which
   all but the first in document order are repeats.
4. Repeats are gathered by document and cut.

Anchors with very many different runs (a frequent line between ever other neighbours) would fill one shard. They are counted
first, and their strings are dealt one by one, by their own hash, with a minimum that is summed where rows lie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import _DOWN, _UP, mixed, parts_for, stored, utf8

WIDTH = 100
ANCHOR = 20
#: Text bytes whose anchors, or whose own bytes, one task handles.
BYTES_PER_SHARD = 16 << 20
INDEX_BYTES = 2 << 20
#: Runs of one anchor that a shard takes.
HOT_RUNS = 100_000
_PIECE = 1 << 17  # below the length of the power tables

RECORD = np.dtype([("key", "<u8"), ("span", "<u8"), ("doc", "<i8"), ("crc", "<u4"), ("start", "<u4"), ("before", "u1"), ("count", "u1")])
MARK = np.dtype([("doc", "<i8"), ("crc", "<u4"), ("start", "<u4"), ("count", "<u4")])
_NO_ID = -(1 << 63)  # stands for a null id


def runs(data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, crc: np.ndarray, base: np.ndarray, width: int, k: int) -> np.ndarray:
    """The records of texts (or pieces of texts that begin at `base`), less than 128 KB together or one piece."""
    n = len(data)
    if n < width:
        return np.zeros(0, RECORD)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:n], out=prefix[1:])
    gram = mixed((prefix[k:] - prefix[:-k]) * _DOWN[: n - k + 1])
    # The place is in the low bits, so the minimum gives the leftmost least anchor.
    low = np.uint64((1 << 20) - 1)
    placed = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    w = width - k + 1
    padded = np.full(-(-len(placed) // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(placed)] = placed
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    anchor = (np.minimum(behind[:m], ahead[w - 1 : w - 1 + m]) & low).astype(np.int64)
    row = np.repeat(np.arange(len(doc)), np.diff(offsets))[:m]
    starts = np.flatnonzero(np.arange(m) + width <= offsets[1:][row])
    if not len(starts):
        return np.zeros(0, RECORD)
    a = anchor[starts]
    new = np.ones(len(starts), bool)
    new[1:] = a[1:] != a[:-1]
    at = np.flatnonzero(new)
    first, count = starts[at], np.diff(np.append(at, len(starts)))
    out = np.zeros(len(first), RECORD)
    own = row[first]
    end = first + count + width - 1
    out["key"] = gram[a[at]]
    out["before"] = a[at] - first
    out["count"] = count
    out["span"] = mixed((prefix[end] - prefix[first]) * _DOWN[first] + (out["before"].astype(np.uint64) << np.uint64(8)) + count.astype(np.uint64))
    out["doc"], out["crc"] = doc[own], crc[own]
    out["start"] = first - offsets[own] + base[own]
    return out


def settle(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each group of equal runs in document order, the repeats), without records that come twice."""
    r = r[np.lexsort((r["start"], r["crc"], r["doc"], r["span"], r["key"]))]
    same = np.zeros(len(r), bool)
    same[1:] = (r["key"][1:] == r["key"][:-1]) & (r["span"][1:] == r["span"][:-1])
    twice = same.copy()
    twice[1:] &= (r["doc"][1:] == r["doc"][:-1]) & (r["crc"][1:] == r["crc"][:-1]) & (r["start"][1:] == r["start"][:-1])
    return r[~same], r[same & ~twice]


def _mark(r: np.ndarray) -> np.ndarray:
    out = np.zeros(len(r), MARK)
    for n in MARK.names:
        out[n] = r[n]
    return out


def _bucket(doc: np.ndarray, crc: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(doc.astype(np.uint64) ^ (crc.astype(np.uint64) << np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def _dealt(kind: int, target: np.ndarray, records: np.ndarray, extra: list[bytes] | None = None) -> list[tuple]:
    """(kind, target, blob, bytes) rows with the records of each target; extra: bytes that go with the records."""
    if not len(records):
        return []
    order = np.argsort(target, kind="stable")
    target, records = target[order], records[order]
    cuts = np.flatnonzero(np.diff(target)) + 1
    out = []
    for a, b in zip([0, *cuts], [*cuts, len(records)], strict=True):
        out.append((kind, int(target[a]), records[a:b].tobytes(), b"".join(extra[i] for i in order[a:b]) if extra is not None else b""))
    return out


_ROWS = "kind int, target long, blob binary, bytes binary"
_SHARD, _REPEATS, _NEEDS, _HOT = 0, 1, 2, 3


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds, targets, blobs, raw = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(targets, pa.int64()), pa.array(blobs, pa.binary()), pa.array(raw, pa.binary())], ["kind", "target", "blob", "bytes"])


def _pieces(offsets: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, begins, ends) of texts below the piece size together; longer texts come in pieces that overlap by width - 1 bytes."""
    rows, begins, ends, total = [], [], [], 0
    for i in range(len(offsets) - 1):
        a, b = int(offsets[i]), int(offsets[i + 1])
        at = a
        while True:
            end = min(b, at + _PIECE)
            if total + end - at > _PIECE and rows:
                yield np.array(rows), np.array(begins), np.array(ends)
                rows, begins, ends, total = [], [], [], 0
            rows.append(i)
            begins.append(at)
            ends.append(end)
            total += end - at
            if end == b:
                break
            at = end - width + 1
    if rows:
        yield np.array(rows), np.array(begins), np.array(ends)


def _records(batch: pa.RecordBatch, width: int, k: int) -> Iterator[np.ndarray]:
    """Records of the texts of a batch (doc, crc, text), about 4 MB of text at a time."""
    data, offsets, _ = utf8(batch.column(2))
    doc = np.asarray(batch.column(0))
    crc = np.asarray(batch.column(1)).astype(np.uint32)
    out, held = [], 0
    for rows, begins, ends in _pieces(offsets, width):
        own = np.concatenate([[0], np.cumsum(ends - begins)])
        joined = np.concatenate([data[a:b] for a, b in zip(begins, ends, strict=True)])
        out.append(runs(joined, own, doc[rows], crc[rows], begins - offsets[rows], width, k))
        held += len(joined)
        if held > 4 << 20:
            yield np.concatenate(out)
            out, held = [], 0
    if out:
        yield np.concatenate(out)


class RunLengthIndex:
    """The run-length compressed transform of a text of symbols 1 to 256, with 0 between strings."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        self.text, self.levels = text, []
        padded = np.concatenate([text, np.zeros(7, text.dtype)]).astype(np.uint64)
        key = np.zeros(n, np.uint64)
        for i in range(7):
            key = (key << np.uint64(9)) | padded[i : i + n]
        h = 7
        while True:  # rank by the first h symbols; a suffix that ends is least
            values, rank = np.unique(key, return_inverse=True)
            self.levels.append((h, rank.astype(np.int32)))
            if len(values) == n:
                break
            after = np.zeros(n, np.uint64)
            if h < n:
                after[: n - h] = rank[h:] + 1
            key = rank.astype(np.uint64) * np.uint64(n + 1) + after
            h *= 2
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)
        transform = text[self.order - 1].astype(np.int16)
        transform[self.order == 0] = -1
        self.heads = np.flatnonzero(np.append(True, transform[1:] != transform[:-1]))
        #: Symbols of the runs, and text places at their two ends.
        self.symbols = transform[self.heads]
        self.first = self.order[self.heads]
        self.last_before = self.order[self.heads - 1]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the suffixes at i and j, by ranks of halving lengths."""
        n = len(self.text)
        i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for h, rank in reversed(self.levels):
            ok = (i + h <= n) & (j + h <= n)
            ok[ok] = rank[i[ok]] == rank[j[ok]]
            for v in (i, j, total):
                v[ok] += h
        for _ in range(self.levels[0][0]):
            ok = (i < n) & (j < n)
            ok[ok] = self.text[i[ok]] == self.text[j[ok]]
            for v in (i, j, total):
                v[ok] += 1
        return total

    def matching_lengths(self) -> np.ndarray:
        """For each text place, how far its suffix matches the suffix before it in suffix order."""
        n = len(self.text)
        at = np.zeros(n, np.int64)
        at[self.first[1:]] = self.common(self.first[1:], self.last_before[1:]) + self.first[1:]
        at[self.first[0]] = self.first[0]
        return np.maximum(np.maximum.accumulate(at) - np.arange(n), 0)

    def repeats(self, width: int) -> np.ndarray:
        """Places whose next `width` symbols also start at a lower place; strings hold no 0."""
        lengths = self.matching_lengths()[self.order]
        begins = np.flatnonzero(np.append(True, lengths[1:] < width))
        first = np.minimum.reduceat(self.order, begins)
        sizes = np.diff(np.append(begins, len(self.order)))
        first = np.repeat(first, sizes)
        zeros = np.concatenate([[0], np.cumsum(self.text == 0)])
        places = np.sort(self.order[(self.order != first) & (np.repeat(sizes, sizes) > 1)])
        places = places[places + width <= len(self.text)]
        return places[zeros[places + width] == zeros[places]]


def _ranges(places: np.ndarray, begin: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Marks for index places; begin: the place of each record's first byte."""
    if not len(places):
        return np.zeros(0, MARK)
    own = np.searchsorted(begin, places, side="right") - 1
    new = np.append(True, (np.diff(places) > 1) | (np.diff(own) > 0))
    at = np.flatnonzero(new)
    out = np.zeros(len(at), MARK)
    of = own[at]
    out["doc"], out["crc"] = r["doc"][of], r["crc"][of]
    out["start"] = r["start"][of] + (places[at] - begin[of])
    out["count"] = np.diff(np.append(at, len(places)))
    return out


def _hot_anchors(texts: DataFrame, width: int, k: int, most: int) -> np.ndarray:
    """Anchors with more than `most` runs; a task reports those that may be among them."""
    tasks = max(1, texts.rdd.getNumPartitions())
    least = max(16, most // tasks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [settle(r)[0]["key"] for batch in batches for r in _records(batch, width, k)]
        key, n = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        many = n >= least
        yield pa.RecordBatch.from_arrays([pa.array(key[many].view(np.int64)), pa.array(n[many].astype(np.int64))], ["key", "n"])

    # At most (runs / most) anchors; a run takes about 40 bytes of text.
    found = texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > most)
    return np.sort(np.array([r.key for r in found.select("key").collect()], np.int64).view(np.uint64))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, k: int = ANCHOR, hot_runs: int = HOT_RUNS, bytes_per_shard: int = BYTES_PER_SHARD, with_text: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the bytes that stay with_text.

    A byte is removed if a string of `width` bytes covers it that also starts earlier: in a document with a smaller id, or earlier in
    the same document. Texts are UTF-8 bytes; what stays may split a character. Null texts are empty; a null id
    is less than any other. Rows with the same id are ordered by their text's checksum; rows that repeat both id and text are one
    document, judged once, and get the same result. Texts of any length are judged whole; an empty table gives no rows. Other columns of
    docs are not read.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NO_ID)).alias("doc"), F.crc32(body).alias("crc"), body.alias("text"), F.col(f"`{doc_id}`").alias("doc_id"))
    volume = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = parts_for(volume, bytes_per_shard)
    slim = texts.select("doc", "crc", "text")
    hot = spark.sparkContext.broadcast(_hot_anchors(slim, width, k, hot_runs))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = hot.value
        for batch in batches:
            for r in _records(batch, width, k):
                first, again = settle(r)
                is_hot = np.isin(first["key"], heavy)
                cold, own = first[~is_hot], first[is_hot]
                rows = _dealt(_SHARD, (cold["key"] % np.uint64(shards)).astype(np.int64), cold)
                rows += _dealt(_REPEATS, _bucket(again["doc"], again["crc"], shards), _mark(again))
                rows += _dealt(_HOT, _bucket(own["doc"], own["crc"], shards), own)
                yield _table(rows)

    def compare(table: pa.Table) -> pa.Table:
        kind = table["kind"][0].as_py()
        if kind != _SHARD:
            return table
        first, again = settle(np.frombuffer(b"".join(table["blob"].to_pylist()), RECORD))
        shared = np.zeros(len(first), bool)
        shared[1:] = first["key"][1:] == first["key"][:-1]
        shared[:-1] |= shared[1:].copy()
        needs = first[shared]
        rows = _dealt(_REPEATS, _bucket(again["doc"], again["crc"], shards), _mark(again))
        rows += _dealt(_NEEDS, _bucket(needs["doc"], needs["crc"], shards), needs)
        return pa.Table.from_batches([_table(rows)])

    found = slim.mapInArrow(anchors, _ROWS)
    # Only what is to be compared is grouped; the rest passes by.
    settled = stored(found.withColumn("salt", F.when(F.col("kind") == _SHARD, 0).otherwise(F.pmod(F.xxhash64("blob"), F.lit(16)))).groupBy("kind", "target", "salt").applyInArrow(_without_salt(compare), _ROWS), "settled-runs")

    bucket_sql = _bucket_column("doc", "crc", shards)
    bucketed = texts.withColumn("bucket", bucket_sql)

    def fetch(key, own: pa.Table, wanted: pa.Table) -> pa.Table:
        """The bytes of runs, for their shards; the strings of hot anchors one by one."""
        if not own.num_rows or not wanted.num_rows:
            return pa.Table.from_batches([_table([])])
        data, offsets, _ = utf8(own["text"].combine_chunks())
        rows = []
        for kind in (_NEEDS, _HOT):
            part = wanted.filter(pc.equal(wanted["kind"], kind))
            if not part.num_rows:
                continue
            r = np.frombuffer(b"".join(part["blob"].to_pylist()), RECORD)
            r = r[np.lexsort((r["start"], r["crc"], r["doc"]))]
            begin = offsets[_rows_of(own, r)] + r["start"]
            spans = [data[a : a + c + width - 1].tobytes() for a, c in zip(begin.tolist(), r["count"].tolist(), strict=True)]
            if kind == _NEEDS:
                rows += _dealt(_SHARD, (mixed(r["key"]) >> np.uint64(24)).astype(np.int64) % (1 << 20), r, spans)
            else:
                for x, s in zip(r, spans, strict=True):
                    for i in range(int(x["count"])):
                        mark = np.zeros(1, MARK)
                        mark["doc"], mark["crc"], mark["start"], mark["count"] = x["doc"], x["crc"], x["start"] + i, 1
                        rows.append((_HOT, 0, mark.tobytes(), hashlib.blake2b(s[i : i + width], digest_size=16).digest()))
        return pa.Table.from_batches([_table(rows)])

    size = settled.where(F.col("kind") == _NEEDS).agg(F.sum(F.length("blob"))).first()[0] or 0
    index_shards = parts_for(size / RECORD.itemsize * (width + 50), INDEX_BYTES)
    fetched = bucketed.groupBy("bucket").cogroup(settled.where(F.col("kind").isin(_NEEDS, _HOT)).groupBy("target")).applyInArrow(fetch, _ROWS)

    def index(table: pa.Table) -> pa.Table:
        r = np.frombuffer(b"".join(table["blob"].to_pylist()), RECORD)
        raw = np.frombuffer(b"".join(table["bytes"].to_pylist()), np.uint8)
        sizes = r["count"].astype(np.int64) + width - 1
        ends = np.cumsum(sizes)
        order = np.lexsort((r["start"], r["crc"], r["doc"]))
        r, ends, sizes = r[order], ends[order], sizes[order]
        begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        symbols = np.zeros(int((sizes + 1).sum()), np.uint16)
        take = np.repeat(ends - sizes - begin, sizes + 1) + np.arange(len(symbols))
        inside = np.ones(len(symbols), bool)
        inside[begin + sizes] = False
        symbols[inside] = raw[take[inside]].astype(np.uint16) + 1
        marks = _ranges(RunLengthIndex(symbols).repeats(width), begin, r)
        return pa.Table.from_batches([_table(_dealt(_REPEATS, _bucket(marks["doc"], marks["crc"], shards), marks))])

    by_index = fetched.where(F.col("kind") == _SHARD).withColumn("target", F.pmod("target", F.lit(index_shards)))
    marks = settled.where(F.col("kind") == _REPEATS).select("target", "blob").union(by_index.groupBy("target").applyInArrow(index, _ROWS).select("target", "blob"))
    if len(hot.value):
        marks = marks.union(_hot_repeats(stored(fetched.where(F.col("kind") == _HOT), "hot-strings"), shards))

    def cut(key, own: pa.Table, wanted: pa.Table) -> pa.Table:
        """Remove what is marked from the texts of a bucket."""
        data, offsets, _ = utf8(own["text"].combine_chunks())
        n = own.num_rows
        if wanted.num_rows:
            m = np.frombuffer(b"".join(wanted["blob"].to_pylist()), MARK)
        else:
            m = np.zeros(0, MARK)
        step = np.zeros(len(data) + 1, np.int32)
        for row, copy in _copies_of(own, m):
            begin = offsets[row] + m["start"][copy]
            np.add.at(step, begin, 1)
            np.add.at(step, begin + m["count"][copy] + width - 1, -1)
        gone = np.cumsum(step[:-1]) > 0
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[offsets])
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = offsets[:-1][offsets[:-1] < len(data)]
        begins[inner] = gone[inner]
        spans = np.diff(np.concatenate([[0], np.cumsum(begins)])[offsets])
        digests, kept = [], []
        for a, b, cut_some in zip(offsets[:-1].tolist(), offsets[1:].tolist(), (removed > 0).tolist(), strict=True):
            rest = data[a:b][~gone[a:b]].tobytes() if cut_some else data[a:b].tobytes()
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest if with_text else None)
        return pa.table({"doc_id": own["doc_id"], "n_bytes": np.diff(offsets), "n_removed": removed.astype(np.int64), "n_spans": spans.astype(np.int64), "kept_sha256": pa.array(digests, pa.string()), "kept": pa.array(kept, pa.binary())}) if n else _nothing(own)

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    out = bucketed.groupBy("bucket").cogroup(marks.groupBy("target")).applyInArrow(cut, schema)
    return out if with_text else out.drop("kept")


def _nothing(own: pa.Table) -> pa.Table:
    none = pa.array([], pa.int64())
    return pa.table({"doc_id": own["doc_id"], "n_bytes": none, "n_removed": none, "n_spans": none, "kept_sha256": pa.array([], pa.string()), "kept": pa.array([], pa.binary())})


def _without_salt(f):
    return lambda table: f(table.drop_columns(["salt"]))


def _bucket_column(doc: str, crc: str, buckets: int):
    """A document's bucket, as _bucket computes it."""

    @F.pandas_udf("long")
    def bucket(d, c):
        import pandas as pd

        return pd.Series(_bucket(d.to_numpy(np.int64), c.to_numpy(np.int64).astype(np.uint32), buckets))

    return bucket(doc, crc)


def _order_of(own: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    key = np.empty(own.num_rows, [("doc", "<i8"), ("crc", "<u4")])
    key["doc"], key["crc"] = np.asarray(own["doc"]), np.asarray(own["crc"]).astype(np.uint32)
    order = np.lexsort((key["crc"], key["doc"]))
    return key[order], order


def _find(key: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Places of the records' documents in sorted keys."""
    both = np.empty(len(r), key.dtype)
    both["doc"], both["crc"] = r["doc"], r["crc"]
    values, back = np.unique(both, return_inverse=True)
    lo = np.searchsorted(key["doc"], values["doc"], side="left")
    out = np.empty(len(values), np.int64)
    for i, (v, at) in enumerate(zip(values, lo.tolist(), strict=True)):
        while key["crc"][at] != v["crc"]:
            at += 1
        out[i] = at
    return out[back]


def _rows_of(own: pa.Table, r: np.ndarray) -> np.ndarray:
    key, order = _order_of(own)
    return order[_find(key, r)]


def _copies_of(own: pa.Table, m: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, marks) pairs: the marks on the first row of each document, then on rows that repeat it."""
    if not len(m) or not own.num_rows:
        return
    key, order = _order_of(own)
    at, marks = _find(key, m), np.arange(len(m))
    document = at.copy()
    while len(at):
        yield order[at], marks
        at, document, marks = at + 1, document, marks
        more = at < len(key)
        more[more] = key[at[more]] == key[document[more]]
        at, document, marks = at[more], document[more], marks[more]


def _hot_repeats(strings: DataFrame, shards: int) -> DataFrame:
    """(target, blob) marks of strings that aren't the first with their bytes: a minimum per string, and a join with it."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.frombuffer(b"".join(batch.column(2).to_pylist()), MARK)
            yield pa.RecordBatch.from_arrays([batch.column(3), pa.array(m["doc"]), pa.array(m["crc"].astype(np.int64)), pa.array(m["start"].astype(np.int64))], ["string", "doc", "crc", "start"])

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.zeros(batch.num_rows, MARK)
            m["doc"], m["crc"], m["start"], m["count"] = *[np.asarray(batch.column(i)) for i in range(3)], 1
            rows = _dealt(_REPEATS, _bucket(m["doc"], m["crc"], shards), m)
            yield _table(rows).select(["target", "blob"])

    rows = strings.mapInArrow(opened, "string binary, doc long, crc long, start long").distinct()
    first = rows.groupBy("string").agg(F.min(F.struct("doc", "crc", "start")).alias("first"))
    again = rows.join(first, "string").where(F.struct("doc", "crc", "start") != F.col("first"))
    return again.select("doc", "crc", "start").mapInArrow(closed, "target long, blob binary")
