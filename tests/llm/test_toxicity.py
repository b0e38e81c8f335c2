import zlib

import numpy as np
import pyarrow as pa
import pytest

from llm import toxicity
from sample_texts import prose


@pytest.fixture(scope="module")
def corpus(spark):
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        text = prose(i, 30 + i % 50) + (f" you vile{i % 4} person" if bad else "") + " " + prose(i + 5000, 20)
        rows.append((i, text, "en", "s"))
        labels.append((i, 1, int(bad)))
    rows += [(5000, None, None, None), (5001, "", None, None), (None, "well, you vile1 person, you vile2 person", None, None), (5002, "vile1", "en", "s"), (5002, "vile1", "en", "s")]
    labels += [(None, 1, 1), (3, None, None), (5003, 0, 1), (0, 1, 1), (7, 0, 0)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, score string, source string").repartition(4),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


@pytest.fixture(scope="module")
def scored(corpus):
    docs, labels = corpus
    return toxicity.score(docs, toxicity.train(docs, labels)).collect()


def test_held_out_accuracy(corpus, scored):
    by_id = {r.doc_id: r for r in scored}
    assert len(scored) == corpus[0].count()
    for i, r in by_id.items():
        assert r.held_out == (i is None or zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    out = [(by_id[i].predicted, int(i % 6 == 0)) for i in range(900) if by_id[i].held_out]
    assert len(out) > 100 and sum(p == y for p, y in out) / len(out) > 0.97
    assert by_id[None].predicted == 1 and by_id[5000].predicted == by_id[5001].predicted == 0


def test_held_out_labels_teach_nothing(spark, corpus, scored):
    docs, labels = corpus
    changed = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    again = toxicity.score(docs, toxicity.train(docs, changed)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, scored))


def test_rejection_keeps_rows_as_they_were(corpus, scored):
    docs, labels = corpus
    named = docs.selectExpr("*", "7.5D AS predicted", "doc_id AS held_out")
    out = toxicity.reject_toxic(named, labels)
    assert out.columns == named.columns
    assert out.count() == sum(r.predicted == 0 for r in scored)
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in named.collect()}


def test_nothing_to_learn_rejects_nothing(corpus):
    docs, labels = corpus
    for own in (labels.limit(0), labels.selectExpr("doc_id", "cast(null AS int) AS toxic"), labels.where("toxic = 1"), labels.where("toxic = 0")):
        assert not toxicity.train(docs, own).fitted
        assert toxicity.reject_toxic(docs, own).count() == docs.count()
    none = toxicity.score(docs, toxicity.train(docs, labels.limit(0)))
    assert {r.predicted for r in none.collect()} == {0}
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0


def test_weights_equal_a_plain_loop():
    """FTRL-proximal per coordinate and mini-batch, with dictionaries."""
    rng = np.random.default_rng(3)
    docs = [np.unique(rng.integers(0, 60, rng.integers(1, 12))).astype(np.int32) for _ in range(90)]
    y = (rng.random(90) < 0.4).astype(float)
    s = toxicity.Settings(l1=0.5, epochs=3, batch=8)
    z, n = dict.fromkeys(range(60), 0.0), dict.fromkeys(range(60), 0.0)
    share = (y.sum() + 1) / 92
    bias, bias_n = np.log(share / (1 - share)), 0.0

    def weight(i):
        if abs(z[i]) <= s.l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * s.l1) / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2)

    for epoch in range(s.epochs):
        order = np.random.default_rng(epoch).permutation(90)
        for a in range(0, 90, s.batch):
            own = order[a : a + s.batch]
            errors = {d: 1 / (1 + np.exp(-(bias + sum(weight(i) for i in docs[d])))) - y[d] for d in own}
            for i in sorted({i for d in own for i in docs[d]}):
                g = sum(errors[d] for d in own if i in docs[d])
                g2 = sum(errors[d] ** 2 for d in own if i in docs[d])
                z[i] += g - (np.sqrt(n[i] + g2) - np.sqrt(n[i])) / s.alpha * weight(i)
                n[i] += g2
            bias_n += sum(e * e for e in errors.values())
            bias -= s.alpha / (s.beta + np.sqrt(bias_n)) * sum(errors.values())
    got, got_bias = toxicity._ftrl(docs, y, np.arange(90), 60, s)
    assert np.allclose(got, [weight(i) for i in range(60)], atol=1e-12) and abs(got_bias - bias) < 1e-12
    assert 0 < (got != 0).sum() < 60


def test_l1_leaves_few_weights_and_rates_are_per_coordinate():
    texts = [prose(i, 40) + (" vile" if i % 3 == 0 else "") for i in range(300)]
    y = np.array([float(i % 3 == 0) for i in range(300)])
    model = toxicity.fit([pa.array(texts)], y)
    loose = toxicity.fit([pa.array(texts)], y, toxicity.Settings(l1=0.1))
    assert 0 < len(model.weights) < len(loose.weights) / 3
