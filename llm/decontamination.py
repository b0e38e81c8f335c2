"""Benchmark decontamination: find the test items' word windows in training texts; mark, cut or drop what holds them.

Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters. A benchmark item contributes all its windows
of `width` consecutive words, or itself as one window if it is shorter. Windows are prepared on Spark and, up to a
size bound, broadcast as a hash set. A scan hashes every window of a text in numpy, filters the hashes through
a bitmap, and verifies the few that pass against the windows' words; nothing is shuffled.

A larger benchmark stays on Spark. Its tasks mark their windows' hashes in a bitmap of a fixed size, which is broadcast; windows of texts
that pass it are joined with the benchmark's by their words, and each text's hits are gathered. What is shuffled are those candidates:
the hits, and of the other windows the share that the bitmap lets through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import groups, scan_words, stored, utf8, whole_rows

WIDTH = 10
#: UTF-8 bytes of windows in one broadcast.
BROADCAST_BYTES = 64 << 20
_BITS = 20

_WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Distinct (window, items): windows as words joined by a space, items as sorted text ids.

    Items without words, and null texts, have no window. The windows of an item without an id count, without a name.
    """
    lower = F.translate(F.col(f"`{text}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lower, F.lit(_WORD), F.lit(1))
    return (
        benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), words.alias("words"))
        .where(F.size("words") > 0)
        .select("item", "words", F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1)))).alias("at"))
        .select("item", F.array_join(F.slice("words", F.col("at"), F.lit(width)), " ").alias("window"))
        .groupBy("window")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


class WindowSet:
    """A hash set of windows, with a bitmap of their hashes in front. Broadcast as plain values, built once per worker."""

    def __init__(self, rows: list[tuple[str, list[str]]]):
        self.items = {w.encode(): tuple(items) for w, items in rows}
        self.widths: dict[int, np.ndarray] = {}
        joined = [w.encode() for w, _ in rows]
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in joined])]).astype(np.int64)
        words = scan_words(np.frombuffer(b"".join(joined), np.uint8), offsets)
        first = np.searchsorted(words.row, np.arange(len(joined)))
        sizes = np.bincount(words.row, minlength=len(joined))
        for width in np.unique(sizes):
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[words.window_hash(int(width))[first[sizes == width]] >> np.uint64(64 - _BITS)] = True
            self.widths[int(width)] = bitmap

    def hits(self, words) -> Iterator[tuple[int, int, int, tuple[str, ...]]]:
        """(row, first word, number of words, items) of each verified occurrence."""
        for width, bitmap in self.widths.items():
            found = np.flatnonzero(bitmap[words.window_hash(width) >> np.uint64(64 - _BITS)] & words.whole(width))
            for i in found.tolist():
                items = self.items.get(words.text(i, width))
                if items is not None:
                    yield int(words.row[i]), i, width, items


_sets: dict[str, WindowSet] = {}


def _window_set(key: str, rows) -> WindowSet:
    if key not in _sets:
        _sets.clear()
        _sets[key] = WindowSet(rows)
    return _sets[key]


_HIT_SQL = "array<struct<`from`: bigint, `to`: bigint, first: bigint, `end`: bigint, items: array<string>>>"


def _hits_of(words, offsets: np.ndarray, found: Iterator[tuple]) -> Iterator[tuple[int, dict]]:
    """(row, hit) with places counted within the row's text, in bytes and in words."""
    first_word = np.concatenate([[0], np.cumsum(np.bincount(words.row, minlength=len(offsets) - 1))])
    for row, i, width, more in found:
        byte0, word0 = offsets[row] - offsets[0], first_word[row]
        yield row, {"from": int(words.start[i] - byte0), "to": int(words.end[i + width - 1] - byte0), "first": int(i - word0), "end": int(i + width - word0), **more}


def _scan(docs: DataFrame, text: str, windows: list[tuple[str, list[str]]], finish, finished) -> DataFrame:
    """finish(batch, n_words, hits) for docs and a broadcast benchmark; finished is the schema of what it makes."""
    spark: SparkSession = docs.sparkSession
    key = hashlib.sha256(repr(sorted(windows)).encode()).hexdigest()
    shared = spark.sparkContext.broadcast(windows)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _window_set(key, shared.value)
        for batch in batches:
            data, offsets, _ = utf8(batch.column(at))
            n_words, hits = np.zeros(batch.num_rows, np.int64), [[] for _ in range(batch.num_rows)]
            for a, b in groups(offsets):
                words = scan_words(data, offsets[a : b + 1])
                n_words[a:b] = np.bincount(words.row, minlength=b - a)
                found = ((row, i, width, {"items": items}) for row, i, width, items in known.hits(words))
                for row, hit in _hits_of(words, offsets[a : b + 1], found):
                    hits[a + row].append(hit)
            yield finish(batch, n_words, hits)

    return docs.mapInArrow(run, finished)


# -- benchmarks that are too large to broadcast -----------------------------------------------------------

#: Bits of the bitmap of window hashes: 8 MB.
_MARK_BITS = 26
_SLICES = 64


def _marks(words, width: int) -> np.ndarray:
    """Places in the bitmap of the windows of one width."""
    with np.errstate(over="ignore"):
        return ((words.window_hash(width) ^ np.uint64(width * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(64 - _MARK_BITS)).astype(np.int64)


def _bitmap(windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The bitmap of all windows, 8 to a byte, and the widths that occur. Tasks make their own; these are merged slice by slice."""
    size = (1 << _MARK_BITS) // 8 // _SLICES

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, widths = np.zeros((1 << _MARK_BITS) // 8, np.uint8), set()
        for batch in batches:
            data, offsets, _ = utf8(batch.column(0))
            words = scan_words(data, offsets)
            sizes = np.bincount(words.row, minlength=batch.num_rows)
            first = np.searchsorted(words.row, np.arange(batch.num_rows))
            for width in np.unique(sizes[sizes > 0]).tolist():
                at = np.unique(_marks(words, width)[first[sizes == width]])
                np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
                widths.add(width)
        if widths:
            blobs = [v.tobytes() for v in bits.reshape(_SLICES, -1)]
            yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int32()), pa.array(blobs), pa.array([sorted(widths)] * _SLICES, pa.list_(pa.int32()))], ["slice", "bits", "widths"])

    def merge(table: pa.Table) -> pa.Table:
        total, widths = np.zeros(size, np.uint8), set()
        for blob, own in zip(table["bits"], table["widths"].to_pylist(), strict=True):
            total |= np.frombuffer(blob.as_py(), np.uint8)
            widths.update(own)
        return pa.table({"slice": table["slice"][:1], "bits": [total.tobytes()], "widths": pa.array([sorted(widths)], pa.list_(pa.int32()))})

    schema = "slice int, bits binary, widths array<int>"
    out, widths = np.zeros((_SLICES, size), np.uint8), []
    for r in windows.select("window").mapInArrow(mark, schema).groupBy("slice").applyInArrow(merge, schema).collect():  # 64 rows, 8 MB together
        out[r["slice"]], widths = np.frombuffer(bytes(r.bits), np.uint8), list(r.widths)
    return out.reshape(-1), widths


def _scan_by_join(docs: DataFrame, text: str, windows: DataFrame, finish, finished) -> DataFrame:
    """The same with the benchmark as a table: candidates by a bitmap, verified by a join on their words."""
    spark: SparkSession = docs.sparkSession
    bits, widths = _bitmap(windows)
    shared = spark.sparkContext.broadcast(bits)
    rows = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("uid")), "decontamination-rows")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["uid", "n_words", "window", "from", "to", "first", "end"]
        for batch in batches:
            data, offsets, _ = utf8(batch.column(1))
            uids = batch.column(0).to_pylist()
            for a, b in groups(offsets):
                words = scan_words(data, offsets[a : b + 1])
                # One row for each text's number of words, and one for each candidate.
                out: dict[str, list] = {n: [] for n in names}
                out["uid"], out["n_words"] = uids[a:b], np.bincount(words.row, minlength=b - a).tolist()
                for n in names[2:]:
                    out[n] = [None] * (b - a)
                for width in widths:
                    at = _marks(words, width)
                    passed = np.flatnonzero((shared.value[at >> 3] >> (at & 7) & 1).astype(bool) & words.whole(width)) if len(at) else np.zeros(0, np.int64)
                    found = ((int(words.row[i]), i, width, {"window": words.text(i, width).decode()}) for i in passed.tolist())
                    for row, hit in _hits_of(words, offsets[a : b + 1], found):
                        for n, v in {"uid": uids[a + row], "n_words": None, **hit}.items():
                            out[n].append(v)
                types = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, types, strict=True)], names)

    schema = "uid long, n_words long, window string, `from` long, `to` long, first long, `end` long"
    seen = stored(rows.select("uid", F.col(f"doc.`{text}`").alias("text")).mapInArrow(candidates, schema), "decontamination-candidates")
    verified = seen.where("window IS NOT NULL").join(windows, "window").select("uid", F.struct("from", "to", "first", "end", "items").alias("hit"))
    hits = verified.groupBy("uid").agg(F.sort_array(F.collect_list("hit")).alias("hits"))  # as many as one text has
    counts = seen.where("n_words IS NOT NULL").select("uid", "n_words")
    whole = rows.join(counts, "uid").join(hits, "uid", "left").select("doc", "n_words", F.coalesce("hits", F.array().cast(_HIT_SQL)).alias("hits"))
    names = docs.columns

    def finish_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_here = pa.RecordBatch.from_arrays(batch.column(0).flatten(), names)
            yield finish(docs_here, np.asarray(batch.column(1)), batch.column(2).to_pylist())

    return whole.mapInArrow(finish_all, finished)


def scan(docs: DataFrame, benchmark: DataFrame, finish, finished, text: str = "text", width: int = WIDTH, most: int = BROADCAST_BYTES) -> DataFrame:
    """What finish makes of docs, the numbers of words and all hits. A null text has no words."""
    windows = stored(benchmark_windows(benchmark, width=width), "benchmark-windows")
    size = F.octet_length("window") + F.octet_length(F.array_join("items", ","))
    if (windows.agg(F.sum(size.cast("long"))).first()[0] or 0) > most:
        return _scan_by_join(docs, text, windows, finish, finished)
    return _scan(docs, text, [(r.window, r.items) for r in windows.collect()], finish, finished)  # `most` bytes at most


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, most: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    n_hit counts words inside any occurrence; n_items, items whose windows occur; items_sha256 digests their ids, sorted as text
    and joined by commas (of no items: of the empty string). spans are merged byte ranges, end exclusive.
    Null and empty texts are clean and have no words. Equal rows give equal results. Other columns of docs are not read.
    """
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def finish(batch: pa.RecordBatch, n_words: np.ndarray, found: list[list[dict]]) -> pa.RecordBatch:
        n_hit, n_items, digests, spans = [], [], [], []
        for hits in found:
            covered = _merged([(h["first"], h["end"]) for h in hits])
            items = sorted({i for h in hits for i in h["items"]})
            n_hit.append(sum(b - a for a, b in covered))
            n_items.append(len(items))
            digests.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            spans.append([{"from": a, "to": b} for a, b in _merged([(h["from"], h["to"]) for h in hits])])
        span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digests, pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_()), pa.array(spans, span)],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"],
        )

    kind = slim.schema["doc_id"].dataType.simpleString()
    finished = f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<`from`: bigint, `to`: bigint>>"
    return scan(slim, benchmark, finish, finished, "text", width, most)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", width: int = WIDTH, drop_share: float = 0.5, most: int = BROADCAST_BYTES) -> DataFrame:
    """docs without what occurs in the benchmark; the columns of docs stay.

    A document whose words are hit for a share of drop_share or more is dropped; from others the hit spans are cut. drop_share=0 drops
    every hit document, a value over 1 drops none. Documents without a hit, null texts included, stay as they are. A column n_chars
    follows the texts that are cut.
    """
    rows = whole_rows(docs, F.col(f"`{text}`").alias("text"))

    def finish(batch: pa.RecordBatch, n_words: np.ndarray, found: list[list[dict]]) -> pa.RecordBatch:
        texts, keep = batch.column(1).to_pylist(), np.ones(batch.num_rows, bool)
        for k, own in enumerate(found):
            if own:
                n_hit = sum(b - a for a, b in _merged([(h["first"], h["end"]) for h in own]))
                keep[k] = n_hit < drop_share * n_words[k]
                raw, left, rest = texts[k].encode(), 0, []
                for a, b in _merged([(h["from"], h["to"]) for h in own]):
                    rest.append(raw[left:a])
                    left = b
                texts[k] = b"".join([*rest, raw[left:]]).decode()
        hit = pa.array([bool(own) for own in found], pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), hit], ["row", "text", "hit"]).filter(pa.array(keep))

    out = scan(rows, benchmark, finish, T.StructType([*rows.schema.fields]).add("hit", "boolean"), "text", width, most)
    new = {text: F.col("text"), "n_chars": F.when(F.col("hit"), F.length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return out.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


REPORT_SQL = rf"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), {WIDTH}) AS n, array_to_string(w[i : i + least(len(w), {WIDTH}) - 1], ' ') AS said
  FROM items, unnest(range(1, greatest(len(w) - {WIDTH} + 1, 1) + 1)) AS t(i) WHERE len(w) > 0
), places AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS said
  FROM lowered, (SELECT DISTINCT n FROM windows) AS widths, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n
), hits AS (
  SELECT doc_id, i, p.n, item FROM places p JOIN windows v ON p.n = v.n AND p.said = v.said
), covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(word) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
