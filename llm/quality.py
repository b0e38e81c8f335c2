"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

1. `describe` reduces each whole text to STATISTICS, one scan without a shuffle; `op12` writes them once, about 80 bytes a document.
2. Training joins statistics and labels. Random Fourier features (cosines of fixed random projections) approximate a Gaussian kernel over the
   standardised statistics. Each task adds up its rows' products, the normal equations of ridge regression; these fixed-size sums are combined in
   a tree and solved. All labelled rows count, however many there are.
3. A part of the rows, chosen by a hash of the id, stays out of the regression. Their raw scores are counted in BINS equal bins, and isotonic
   regression over the bins turns raw scores into shares of label 1 that never fall.
4. Scoring is a scan without a shuffle. The model is a few hundred kB at most, whatever the number of rows.

Defined results. A null text is empty; an empty text has all statistics 0 and a score like any other. Equal texts score equally, and repeated rows stay
repeated rows, in training too. Rows without an id teach nothing and count as held out. Labels other than 0 and 1 teach nothing; of several of an id the
largest counts. Without labels of both kinds nothing is learnt: the model says so (`fitted`), scores are the share of label 1, or 0.5, and
`keep_good` keeps all. An empty table gives no rows. Columns of docs with the names of results are replaced by `score`, never by `keep_good`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import groups, mixed, scan_words, stored, utf8, without

FEATURES, RIDGE, BINS, FAN_IN, CUT = 256, 1e-3, 4096, 16, 0.7
SEED = 12

STATISTICS = [
    "log_words", "log_bytes", "letters", "capitals", "other_bytes", "digits", "marks", "sentence_marks", "blanks", "distinct_words",
    "repeated_words", "distinct_pairs", "word_length", "word_spread", "capital_words", "marked_words", "lines",
]

# -- statistics of texts ---------------------------------------------------------------------------------

_code = np.arange(256)
_LETTER = ((_code | 32) >= 97) & ((_code | 32) <= 122)
_CAPITAL = (_code >= 65) & (_code <= 90)
_DIGIT = (_code >= 48) & (_code <= 57)
_BLANK = (_code <= 32) | (_code == 127)
_SENTENCE = np.isin(_code, list(b".,;:'\"()-"))
_MARK = (_code < 128) & ~_LETTER & ~_DIGIT & ~_BLANK & ~_SENTENCE
_KINDS = [_LETTER, _CAPITAL, _code >= 128, _DIGIT, _MARK, _SENTENCE, _BLANK, _code == 10]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per text, given the texts' bytes and where each begins and ends."""
    n, base = len(offsets) - 1, int(offsets[0])
    raw = data[base : int(offsets[-1])]
    sizes = np.diff(offsets)
    words = scan_words(data, offsets)
    row, length = words.row, (words.end - words.start).astype(np.float64)
    count = np.bincount(row, minlength=n)

    def per_text(kind: np.ndarray) -> np.ndarray:
        total = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(kind[raw], out=total[1:])
        return total[offsets[1:] - base] - total[offsets[:-1] - base]

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1)

    def distinct(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        key = np.sort(rows.astype(np.uint64) << np.uint64(44) | hashes >> np.uint64(20))  # a group has far fewer than 2^20 rows
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        return np.bincount((key[new] >> np.uint64(44)).astype(np.int64), minlength=n)

    letters, capitals, other, digits, marks, sentence, blanks, breaks = (per_text(k) for k in _KINDS)
    pair = row[1:] == row[:-1]
    pair_row = row[1:][pair]
    same = np.bincount(pair_row[words.hash[1:][pair] == words.hash[:-1][pair]], minlength=n)
    pairs = np.bincount(pair_row, minlength=n)
    with np.errstate(over="ignore"):
        both = mixed(words.hash[:-1][pair] * np.uint64(3) + words.hash[1:][pair])
    mean = share(np.bincount(row, length, n), count)
    spread = np.sqrt(np.maximum(share(np.bincount(row, length**2, n), count) - mean**2, 0))
    first = raw[words.start] if len(row) else raw[:0]
    behind = raw[np.minimum(words.end, len(raw) - 1)] if len(row) else raw[:0]
    inside = words.end < (offsets[1:] - base)[row] if len(row) else np.zeros(0, bool)
    return np.column_stack(
        [
            np.log1p(count), np.log1p(sizes), share(letters, sizes), share(capitals, letters), share(other, sizes), share(digits, sizes), share(marks, sizes),
            share(sentence, sizes), share(blanks, sizes), share(distinct(row, words.hash), count), share(same, pairs), share(distinct(pair_row, both), pairs),
            mean, spread, share(np.bincount(row[_CAPITAL[first]], minlength=n), count), share(np.bincount(row[_MARK[behind] & inside], minlength=n), count), share(breaks, count),
        ]
    )


def describe(docs: DataFrame, text: str = "text", into: str = "statistics") -> DataFrame:
    """docs with the statistics of the whole text (array<float>) in place of the text."""
    base = without(docs, into)
    rest = [c for c in base.columns if c != text]
    source = base.select(F.col(f"`{text}`"), *[F.col(f"`{c}`") for c in rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = utf8(batch.column(0))
            parts = [statistics(data, offsets[a : b + 1]) for a, b in groups(offsets)]
            flat = np.concatenate(parts).astype(np.float32).reshape(-1) if parts else np.zeros(0, np.float32)
            at = np.arange(0, len(flat) + 1, len(STATISTICS), dtype=np.int32)
            columns = [batch.column(i + 1) for i in range(len(rest))]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(at, pa.array(flat))], [*rest, into])

    schema = T.StructType([f for f in base.schema if f.name != text]).add(into, T.ArrayType(T.FloatType()))
    return source.mapInArrow(run, schema)


# -- the model -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]  # raw scores, calibrated scores; straight lines between
    fitted: bool
    prior: float = 0.5

    def raw(self, statistics: np.ndarray) -> np.ndarray:
        return fourier((statistics - self.mean) / self.scale) @ self.weights

    def score(self, statistics: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(statistics), self.prior)
        return np.clip(np.interp(self.raw(statistics), *self.steps), 0, 1)


def fourier(x: np.ndarray, features: int = FEATURES, seed: int = SEED) -> np.ndarray:
    """Features whose products approximate exp(-|x - y|²/2s²), s² the number of statistics, and a constant. Far values count as 8 deviations."""
    rng = np.random.default_rng(seed)
    width = x.shape[1]
    directions, phases = rng.normal(size=(width, features)) / np.sqrt(width), rng.uniform(0, 2 * np.pi, features)
    out = np.ones((len(x), features + 1))
    out[:, :features] = np.sqrt(2 / features) * np.cos(np.clip(x, -8, 8) @ directions + phases)
    return out


def isotonic(hits: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The non-falling sequence closest to hits/counts in weighted squares, by pooling neighbours that violate the order. counts > 0."""
    blocks: list[list[float]] = []  # hits, counts, members
    for h, c in zip(hits.tolist(), counts.tolist(), strict=True):
        blocks.append([h, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            h, c, m = blocks.pop()
            blocks[-1][0] += h
            blocks[-1][1] += c
            blocks[-1][2] += m
    return np.repeat([h / c for h, c, _ in blocks], [m for *_, m in blocks])


_SUMS = "part long, products binary, targets binary"


def _normal_equations(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over (statistics, label), summed per task, then in a tree of fixed fan-in."""

    def batch_of(part: int, products: np.ndarray, targets: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([products.tobytes()]), pa.array([targets.tobytes()])], ["part", "products", "targets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, targets, any_row = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1), False
        for batch in batches:
            z = fourier((_matrix(batch.column(0)) - mean) / scale)
            products += z.T @ z
            targets += z.T @ np.asarray(batch.column(1)).astype(np.float64)
            any_row = True
        if any_row:
            yield batch_of(TaskContext.get().partitionId(), products, targets)

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table["part"]), kind="stable").tolist()
        sums = [sum(np.frombuffer(table[c][i].as_py()) for i in order) for c in ("products", "targets")]
        return pa.Table.from_batches([batch_of(table["part"][order[0]].as_py() // FAN_IN, *sums)])

    level = stored(rows.select("statistics", "label").mapInArrow(run, _SUMS), "normal-equations")
    most = level.agg(F.max("part")).first()[0] or 0
    while most:
        level = level.groupBy(F.floor(F.col("part") / FAN_IN).alias("group")).applyInArrow(add, _SUMS)
        most //= FAN_IN
    total = level.first()
    return np.frombuffer(bytes(total.products)).reshape(FEATURES + 1, -1), np.frombuffer(bytes(total.targets))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1)


def training_rows(described: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(label, statistics, calibrates) of all labelled rows that aren't held out. Held out are ids whose crc32 as text is 2 modulo 4."""
    own = labels.select(F.col("doc_id"), F.col(f"`{label}`").cast("int").alias("label")).where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    own = own.where(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    calibrates = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    return described.select("doc_id", "statistics").join(own, "doc_id").select("label", "statistics", calibrates.alias("calibrates"))


def train(described: DataFrame, labels: DataFrame, label: str = "quality", ridge: float = RIDGE) -> Model:
    """Fit on the training rows of described documents (doc_id, statistics)."""
    rows = stored(training_rows(described, labels, label), "training-rows")
    at = range(len(STATISTICS))
    moments = [f(F.col("statistics")[i]).alias(f"{n}{i}") for i in at for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    kinds = [F.count("*").alias("n"), F.sum("label").alias("ones"), F.count_if("calibrates").alias("held"), F.sum(F.when(F.col("calibrates"), F.col("label"))).alias("held_ones")]
    facts = rows.agg(*moments, *kinds).first()
    n, ones, held, held_ones = facts.n, facts.ones or 0, facts.held, facts.held_ones or 0
    mean = np.array([facts[f"m{i}"] or 0.0 for i in at])
    scale = np.maximum([facts[f"s{i}"] or 0.0 for i in at], 1e-6)
    if not 0 < ones < n:
        return Model(mean, scale, np.zeros(FEATURES + 1), (np.zeros(1), np.zeros(1)), False, (ones + 1) / (n + 2))
    # Few labels leave nothing to calibrate on but what the regression has seen.
    apart = 0 < held_ones < held and 0 < ones - held_ones < n - held
    products, targets = _normal_equations(rows.where(~F.col("calibrates")) if apart else rows, mean, scale)
    weights = np.linalg.solve(products + ridge * products[-1, -1] * np.eye(len(targets)), targets)
    model = Model(mean, scale, weights, (np.zeros(1), np.zeros(1)), True, ones / n)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(_matrix(batch.column(0)))
            bins = np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], ["bin", "label"])

    seen = rows.where("calibrates") if apart else rows
    counted = seen.select("statistics", "label").mapInArrow(binned, "bin int, label int").groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("ones"))
    bins = sorted((r.bin, r.n, r.ones) for r in counted.collect())  # BINS rows at most
    center, counts, hits = (np.array(v, np.float64) for v in zip(*bins, strict=True))
    return Model(mean, scale, weights, ((center + 0.5) / BINS * 2 - 0.5, isotonic(hits, counts)), True, ones / n)


def score(described: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """described documents with held_out, score and predicted (score >= cut); the statistics are dropped."""
    base = without(described, "held_out", "score", "predicted")
    names = [c for c in base.columns if c != "statistics"]
    shared = described.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = shared.value.score(_matrix(batch.column(0))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(p), pa.array((p >= cut).astype(np.int32))], [*names, "score", "predicted"])

    schema = T.StructType([f for f in base.schema if f.name != "statistics"]).add("score", "double").add("predicted", "integer")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    return base.select("statistics", *[F.col(f"`{c}`") for c in names]).mapInArrow(run, schema).withColumn("held_out", held)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of all documents, by a model trained on those with labels."""
    described = stored(describe(docs.select("doc_id", "text")), "statistics")
    return score(described, train(described, labels)).select("doc_id", "held_out", "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """docs without those that score below the cut, every column as it was; all of them if the labels teach nothing."""
    described = stored(describe(docs.select("doc_id", "text")), "statistics")
    model = train(described, labels)
    if not model.fitted:
        return docs
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = describe(docs.select(whole.alias("whole"), "doc_id", "text"))
    return score(rows, model, cut).where("predicted = 1").select("whole.*")
