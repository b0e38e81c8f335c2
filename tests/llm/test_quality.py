"""Quality scores: held-out labels, normal equations and calibration against plain arithmetic."""

import random
import zlib

import numpy as np
import pytest
from sample_texts import awkward_texts, prose

from llm import quality
from llm.common import utf8

SCHEMA = "doc_id long, text string, score string, predicted string, whole int, statistics string"


def junk(i):
    rng = random.Random(i)
    words = prose(i, 40 + i % 30).split(" ")
    return [" ".join(w + rng.choice(["###", "%%%"]) for w in words), " ".join(words).upper() + "!!", " | ".join(words), " ".join(w for w in words for _ in range(12))][i % 4]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, junk(i) if i % 5 == 0 else prose(i, 30 + i % 60) + ".\n" + prose(i + 9000, 25) + ".") for i in range(1200)]
    labels = [(i, int(i % 5 != 0), 0) for i in range(1200)]
    extra = [(5000 + i, t) for i, t in enumerate(awkward_texts())] + [(None, "no id"), (None, None), rows[3], (7, "another text")]
    labels += [(None, 0, 1), (9, None, 0), (11, 7, 0), (13, 0, 0), (13, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows + extra], SCHEMA).repartition(5)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def scored(corpus):
    return quality.quality_scores(*corpus).collect()


def test_held_out_accuracy(corpus, scored):
    assert len(scored) == corpus[0].count()
    for r in scored:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    out = [(r.predicted, int(r.doc_id % 5 != 0)) for r in scored if r.held_out and r.doc_id is not None and r.doc_id < 1200 and r.doc_id != 7]
    assert len(out) > 200 and np.mean([p == y for p, y in out]) > 0.97


def test_held_out_labels_teach_nothing(corpus, scored):
    docs, labels = corpus
    changed = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality", "toxic")
    again = quality.quality_scores(docs, changed).collect()
    as_told = lambda rows: sorted((repr(r.doc_id), r.held_out, round(r.score, 9), r.predicted) for r in rows)
    assert as_told(again) == as_told(scored)


def test_keep_good_returns_rows_as_they_were(corpus, scored):
    docs, labels = corpus
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    left = [tuple(r) for r in kept.collect()]
    assert len(left) == sum(r.predicted for r in scored)
    assert set(left) <= {tuple(r) for r in docs.collect()}
    assert {r[2:] for r in left} == {("x", "y", 1, "z")}


def test_nothing_to_learn(spark, corpus):
    docs, labels = corpus
    for own, prior in ((labels.limit(0), 0.5), (labels.selectExpr("doc_id", "cast(null AS int) AS quality"), 0.5)):
        assert {r.score for r in quality.quality_scores(docs, own).collect()} == {prior}
        assert quality.keep_good(docs, own).count() == docs.count()
    ones = quality.quality_scores(docs, labels.where("quality = 1")).collect()
    assert {r.predicted for r in ones} == {1}
    assert quality.quality_scores(docs.limit(0), labels).collect() == []


def test_statistics_by_brute_force():
    texts = [t for t in awkward_texts() if t is None or len(t) < 5000] + ["One two two three. TWO", "a### b| c", "x"]
    import pyarrow as pa
    from sample_texts import words

    data, offsets, _ = utf8(pa.array(texts))
    got = quality.statistics(data, offsets)
    for t, row in zip(texts, got, strict=True):
        w, b = words(t), (t or "").encode()
        v = dict(zip(quality.STATISTICS, row, strict=True))
        share = lambda a, n: a / max(n, 1)
        assert v["log_words"] == pytest.approx(np.log1p(len(w))) and v["log_bytes"] == pytest.approx(np.log1p(len(b)))
        assert v["distinct_words"] == share(len(set(w)), len(w))
        assert v["repeated_words"] == share(sum(x == y for x, y in zip(w, w[1:], strict=False)), len(w) - 1)
        assert v["distinct_pairs"] == share(len(set(zip(w, w[1:], strict=False))), len(w) - 1)
        assert v["word_length"] == pytest.approx(share(sum(len(x.encode()) for x in w), len(w)))
        assert v["digits"] == share(sum(48 <= c <= 57 for c in b), len(b)) and v["lines"] == share(b.count(10), len(w))
        assert v["capitals"] == share(sum(65 <= c <= 90 for c in b), sum(65 <= (c & ~32) <= 90 for c in b))


def test_features_approximate_the_kernel():
    x = np.random.default_rng(3).normal(size=(60, len(quality.STATISTICS)))
    z = quality.fourier(x, 20_000)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(2)
    assert np.abs(z @ z.T - np.exp(-distance / (2 * x.shape[1]))).max() < 0.05


def test_normal_equations_of_many_tasks(spark, corpus):
    docs, labels = corpus
    rows = quality.training_rows(quality.describe(docs.select("doc_id", "text")), labels)
    here = rows.collect()
    x, y = np.array([r.statistics for r in here]), np.array([r.label for r in here], float)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = quality.fourier((x - mean) / scale)
    products, targets = quality._normal_equations(rows.repartition(37), mean, scale)
    assert np.allclose(products, z.T @ z) and np.allclose(targets, z.T @ y)
    model = quality.train(quality.describe(docs.select("doc_id", "text")), labels)
    assert np.all(np.diff(model.steps[1]) >= 0)


def test_isotonic_by_its_formula():
    rng = np.random.default_rng(4)
    for n in (1, 2, 9, 30):
        counts = rng.integers(1, 9, n).astype(float)
        hits = np.minimum(rng.integers(0, 9, n), counts).astype(float)
        mean = lambda i, j: hits[i : j + 1].sum() / counts[i : j + 1].sum()
        want = [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]
        assert np.allclose(quality.isotonic(hits, counts), want)
