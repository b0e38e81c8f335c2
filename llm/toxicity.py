"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are 64-bit hashes of words, of neighbouring words and of word pairs with a few words between; a text has
each or has not. FTRL-proximal keeps a learning rate per coordinate and leaves most weights at exactly 0 (L1), so the
trained model is a short list of hashes and weights, which is broadcast. Training takes a bounded sample
of the labelled rows (`max_train`) in one task; scoring is a scan of all whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import Words, groups, mixed, scan_words, utf8, whole_rows, without

#: Labelled rows to learn from at most, about; the sample is drawn by a hash of the id.
MAX_TRAIN = 12_000
MAX_SKIP = 2
MIN_DOCS = 3
_BITS = 20
#: The log-odds of every text if there is no label at all.
NOT_TOXIC = -4.0


@dataclass(frozen=True)
class Settings:
    """alpha and beta set the per-coordinate rates, l1 and l2 the regularisation."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    epochs: int = 5
    batch: int = 32


@dataclass(frozen=True)
class Model:
    """Without labels of both kinds nothing is learnt: `fitted` is false, and all texts score alike."""

    hashes: np.ndarray  # sorted
    weights: np.ndarray
    bias: float
    fitted: bool = True


def feature_hashes(words: Words, max_skip: int = MAX_SKIP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of the features of all texts, kind by kind, repeated as often as they occur."""
    yield words.row, words.hash
    for gap in range(1, max_skip + 2):
        n = len(words.hash) - gap
        if n > 0:
            same = words.row[:n] == words.row[gap:]
            pair = words.hash[:n] * np.uint64(0xD1342543DE82EF95 + 2 * gap) + words.hash[gap:]
            yield words.row[:n][same], mixed(pair[same])


def fit(texts: list[pa.Array], labels: np.ndarray, s: Settings = Settings(), max_skip: int = MAX_SKIP) -> Model:
    """Learn from the texts of some Arrow arrays, in order. Without two classes there are no weights, only a smoothed base rate."""
    positive, total = int(labels.sum()), len(labels)
    prior = float(np.log((positive + 1) / (total - positive + 1)))
    if positive in (0, total):
        return Model(np.zeros(0, np.uint64), np.zeros(0), prior, False)

    def documents() -> Iterator[np.ndarray]:
        for column in texts:
            data, offsets, _ = utf8(column)
            for a, b in groups(offsets):
                pairs = list(feature_hashes(scan_words(data, offsets[a : b + 1]), max_skip))
                row, h = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
                order = np.argsort(row, kind="stable")
                for own in np.split(h[order], np.cumsum(np.bincount(row, minlength=b - a))[:-1]):
                    yield _distinct(own)

    # Three scans keep memory low. Features of fewer than MIN_DOCS texts are left out; counting them in 2^24 slots may keep a few more.
    seen = np.zeros(1 << 24, np.uint16)
    for own in documents():
        slot = _distinct(own >> np.uint64(40))
        seen[slot] = np.minimum(seen[slot], 65534) + 1
    vocabulary, held = np.zeros(0, np.uint64), []
    for own in documents():
        held.append(own[seen[own >> np.uint64(40)] >= MIN_DOCS])
        if len(held) == 2000:
            vocabulary, held = np.union1d(vocabulary, np.concatenate(held)), []
    vocabulary = np.union1d(vocabulary, np.concatenate([*held, vocabulary[:0]]))
    kept = [np.searchsorted(vocabulary, own[seen[own >> np.uint64(40)] >= MIN_DOCS]).astype(np.int32) for own in documents()]
    del seen

    everyone = np.arange(total)
    learn, check = everyone[everyone % 4 != 0], everyone[everyone % 4 == 0]
    w, bias = _ftrl(kept, labels, learn, len(vocabulary), s)
    cut = _best_cut(np.array([bias + w[kept[d]].sum() for d in check]), labels[check])
    w, bias = _ftrl(kept, labels, everyone, len(vocabulary), s)
    used = w != 0
    return Model(vocabulary[used], w[used], bias - cut)


def _ftrl(docs: list[np.ndarray], labels: np.ndarray, rows: np.ndarray, size: int, s: Settings) -> tuple[np.ndarray, float]:
    """Weights and bias from the given rows, in mini-batches."""
    z, n = np.zeros(size), np.zeros(size)
    share = (labels[rows].sum() + 1) / (len(rows) + 2)
    bias, bias_n = float(np.log(share / (1 - share))), 0.0

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= s.l1, 0.0, -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2))

    for epoch in range(s.epochs):
        order = rows[np.random.default_rng(epoch).permutation(len(rows))]
        for at in range(0, len(order), s.batch):
            own = order[at : at + s.batch]
            flat, of = np.concatenate([docs[d] for d in own]), np.repeat(np.arange(len(own)), [len(docs[d]) for d in own])
            i, back = np.unique(flat, return_inverse=True)
            w = weights(i)
            error = sigmoid(bias + np.bincount(of, w[back], len(own))) - labels[own]
            g, g2 = np.bincount(back, error[of], len(i)), np.bincount(back, error[of] ** 2, len(i))
            z[i] += g - (np.sqrt(n[i] + g2) - np.sqrt(n[i])) / s.alpha * w
            n[i] += g2
            bias_n += float((error**2).sum())
            bias -= s.alpha / (s.beta + np.sqrt(bias_n)) * float(error.sum())
    return weights(np.arange(size)), bias


def _best_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """The log-odds between rows of the best F0.5, which puts precision first, on rows the weights haven't seen; 0 if these have one class."""
    if len(set(labels)) < 2:
        return 0.0
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(labels[order])
    f = 1.25 * hits / (np.arange(1, len(order) + 1) + 0.25 * labels.sum())
    k = int(np.argmax(f))
    last = logits[order[k]]
    below = logits[order[k + 1]] if k + 1 < len(order) else last - 1
    return float((last + below) / 2)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, label, text) of about max_train labelled documents that aren't held out, one per id.

    Held out are ids whose crc32 as text is divisible by 5. Rows without an id or label teach nothing; of several labels of an id
    the largest counts; of several texts of an id, the least; a null text is empty.
    """
    own = labels.select(F.col("doc_id"), F.col(f"`{label}`").cast("int").alias("label")).where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    own = own.where(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    n = max(own.count(), 1)
    sample = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < max_train) if n > max_train else own
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The sample's size is bounded by max_train: ids and labels, about 16 bytes each.
    return texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_train: int = MAX_TRAIN, settings: Settings = Settings()) -> Model:
    """Fit on training_rows, in one task whose input max_train bounds. The driver receives the non-zero weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), schema=pa.schema([("label", pa.int32()), ("text", pa.string())]))
        y = np.asarray(rows["label"]).astype(np.float64)
        model = fit(rows["text"].chunks, y, settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.hashes.tobytes()]), pa.array([model.weights.tobytes()]), pa.array([model.bias]), pa.array([model.fitted])], ["hashes", "weights", "bias", "fitted"]
        )

    rows = training_rows(docs, labels, label, max_train).repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    got = rows.select("label", "text").mapInArrow(run, "hashes binary, weights binary, bias double, fitted boolean").first()
    if got is None:  # no labelled document: no text is known to be toxic
        return Model(np.zeros(0, np.uint64), np.zeros(0), NOT_TOXIC, False)
    return Model(np.frombuffer(bytes(got.hashes), np.uint64), np.frombuffer(bytes(got.weights), np.float64), got.bias, got.fitted)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with held_out, score and predicted, from whole texts alone.

    Null and empty texts get the score of the bias. Rows without an id count as held out. Equal texts score equally. Columns of docs
    with the names of results are replaced.
    """
    base = without(docs, "held_out", "score", "predicted")
    names, at = base.columns, base.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast((model.hashes, model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, weights, bias = shared.value
        bitmap = np.zeros(1 << _BITS, bool)
        bitmap[hashes >> np.uint64(64 - _BITS)] = True
        for batch in batches:
            data, offsets, _ = utf8(batch.column(at))
            total = np.full(batch.num_rows, bias)
            for a, b in groups(offsets):
                rows, found = [], []
                for row, h in feature_hashes(scan_words(data, offsets[a : b + 1])):
                    may = np.flatnonzero(bitmap[h >> np.uint64(64 - _BITS)])
                    i = np.minimum(np.searchsorted(hashes, h[may]), len(hashes) - 1)
                    hit = hashes[i] == h[may] if len(may) else np.zeros(0, bool)
                    rows.append(row[may][hit])
                    found.append(i[hit])
                pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(found)]), axis=1)
                total[a:b] += np.bincount(pairs[0].astype(np.int64), weights[pairs[1].astype(np.int64)], b - a)
            p = sigmoid(total)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    schema = T.StructType([*base.schema.fields]).add("score", "double").add("predicted", "integer")
    held = F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 5 == 0, F.lit(True))
    return base.mapInArrow(run, schema).withColumn("held_out", held)


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those predicted toxic; every column stays as it is, whatever its name.

    Without labels of both kinds nothing is learnt and all rows stay. Null and empty texts stay unless most labelled texts are toxic.
    """
    model = train(docs, labels)
    if not model.fitted:
        return docs
    rows = whole_rows(docs, F.col("doc_id"), F.col("text"))
    return score(rows, model).where("predicted = 0").select("row.*")
