"""Rank-one updates against a dense solver, whitening against plain integer and dense arithmetic."""

import math

import numpy as np
import pytest

from llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string, x int, whitened string"


def test_rank_one_updates():
    rng = np.random.default_rng(0)
    for dim in (1, 2, 5, 40):
        d, q, a = np.zeros(dim), np.eye(dim), np.zeros((dim, dim))
        for step in range(60):
            v = rng.normal(size=dim) * 10.0 ** rng.integers(-6, 6)
            if step % 5 == 0:
                v[rng.integers(dim)] = 0
            if step % 7 == 0:
                v = q[:, rng.integers(dim)] * 3  # along an eigenvector: all else is deflated
            if step % 11 == 0:
                v = np.zeros(dim)
            a += np.outer(v, v)
            d, q = whitening.rank_one(d, q, v)
            size = np.abs(a).max() + 1e-300
            assert (np.diff(d) >= 0).all()
            assert np.abs(q.T @ q - np.eye(dim)).max() < 1e-12
            assert np.abs(q * d @ q.T - a).max() < 1e-12 * size
    # Equal and nearly equal eigenvalues.
    d, q = np.array([1.0, 1.0, 1.0 + 1e-15, 2.0, 2.0 + 1e-9]), np.linalg.qr(rng.normal(size=(5, 5)))[0]
    v = rng.normal(size=5)
    e, p = whitening.rank_one(d, q, v)
    assert np.abs(p * e @ p.T - (q * d @ q.T + np.outer(v, v))).max() < 1e-13 and np.abs(p.T @ p - np.eye(5)).max() < 1e-13


def test_spectra_of_blocks_and_parts():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(5000, 12)) @ rng.normal(size=(12, 12)) + 100 * rng.normal(size=12)
    whole, left, right = (whitening.Spectrum.empty(12) for _ in range(3))
    for a in range(0, 3000, 700):
        left.add(x[a : min(a + 700, 3000)])
    for a in range(3000, 5000, 5):
        right.add(x[a : a + 5])
    whole.merge(left)
    whole.merge(whitening.Spectrum.empty(12))
    whole.merge(right)
    scatter = np.cov(x.T, bias=True) * len(x)
    assert whole.n == 5000 and np.allclose(whole.mean, x.mean(0), rtol=1e-12)
    assert np.abs(whole.vectors * whole.values @ whole.vectors.T - scatter).max() < 1e-10 * np.abs(scatter).max()


def expected(rows, components=16):
    by_dim, out = {}, []
    usable = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    for vec_id, e in usable:
        by_dim.setdefault(len(e), []).append((vec_id, tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in e)))
    for dim, own in by_dim.items():
        fit = sorted({x for _, x in own})
        n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
        offsets = {x: [n * c - t for c, t in zip(x, s, strict=True)] for x in fit}
        y = np.array([offsets[x] for x in fit], float).reshape(n, dim) / n
        if not dim or n < 2:
            continue
        e, vectors = np.linalg.eigh(y.T @ y / n)
        e, vectors = e[::-1], vectors[:, ::-1]
        for vec_id, x in own:
            for k in range(min(components, dim)):
                if e[k] > 1e-12 * e[0]:
                    w = (np.array(offsets[x], float) / n) @ vectors[:, k] / math.sqrt(e[k])
                    out.append((vec_id, k + 1, n, sum(o * o for o in offsets[x]), abs(w), e[k] / e.sum()))
    return out


def compare(got, want):
    key = lambda r: (repr(r[0]), r[1], r[3], round(abs(r[4]), 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for g, w in zip(got, want, strict=True):
        assert abs(abs(g[4]) - w[4]) < 1e-8 and abs(g[5] / w[5] - 1) < 1e-9 and 0 <= g[6] < 1e-9


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.normal(size=(24, 24)))[0] * np.geomspace(3, 0.2, 24)
    rows = [(i, (rng.normal(size=24) @ turn.T).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(400)]  # copies
    rows += [rows[3], (None, rows[5][1]), (5000, None), (5001, []), (5002, [None] * 24), (5003, [float("nan")] * 24), (5004, [float("inf")] + [0.0] * 23)]
    rows += [(6000 + i, (rng.normal(size=3) * [5, 1, 0]).tolist()) for i in range(90)]  # a length of its own, without variance in one direction
    rows += [(7000, [1.0, 2.0]), (7001, [1.0, 2.0])]  # a space of one distinct vector
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "w") for r in rows], SCHEMA).repartition(7)


def test_whitened(spark, rows):
    got = whitening.whiten(frame(spark, rows))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = got.collect()
    compare(found, expected(rows))
    signs = {}
    for r in found:  # one sign for all rows of a component
        signs.setdefault((r.n, r.component), []).append(r.whitened)
    assert abs(np.mean(signs[max(signs)[0], 1])) < 1


def test_many_parts_are_combined_in_a_tree(spark, rows):
    spread = whitening.grid(frame(spark, rows)).select("x").distinct().repartition(40)
    spaces = whitening.fit_spaces(spread)
    want = {r[1]: r[5] for r in expected(rows) if r[2] > 500}
    assert np.allclose(spaces[24].values / spaces[24].trace, [want[k] for k in sorted(want)], rtol=1e-10)
    assert set(spaces) == {24, 3} and len(spaces[3].values) == 2


def test_large_entries_and_empty_tables(spark):
    rows = [(i, [float(i * i) * 1e7, float(i), 1e30 * (i == 3)]) for i in range(6)]
    found = {(r.vec_id, r.component): r for r in whitening.whiten(frame(spark, rows)).collect()}
    assert found[3, 1].deviation is None and found[3, 1].n == 6
    far = [(i, [float(i) * 3e5, 1.0]) for i in range(5)]
    compare(whitening.whiten(frame(spark, far)).collect(), expected(far))
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
