import numpy as np
import pytest

from llm.embedding_dedup import near_duplicates


def expected(rows, least):
    def good(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if good(v) else None for _, v in rows]
    links, root = [0] * n, list(range(n))
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    out = []
    for i, (k, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if root[j] == root[i] and rows[j][0] is not None]
        component = min(ids) if ids else k
        out.append((k, links[i], component, k == component))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(150, 16)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    for i in range(60):  # near copies in chains, and copies
        rows.append((200 + i, (x[i % 9] + (i % 5) * 0.12 * rng.normal(size=16)).astype(np.float32).tolist()))
    rows += [(300, rows[0][1]), (301, (2 * x[0]).tolist()), (-5, rows[0][1]), (None, rows[3][1]), (3, rows[4][1])]
    rows += [(400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (403, [float("inf")] + [1.0] * 15), (404, [None] + [1.0] * 15), (405, []), (406, [1.0, 2.0]), (407, [2.0, 4.0]), (None, None)]
    return rows


@pytest.mark.parametrize("block", [4096, 20])
def test_links_and_groups_match_brute_force(spark, vectors, block):
    frame = spark.createDataFrame([(*r, 1, "x") for r in vectors], "vec_id long, embedding array<float>, label int, n_links string").repartition(3)
    got = near_duplicates(frame, block=block, sigmas=None)
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()), key=repr) == expected(vectors, 0.95)


def test_few_spreads_keep_the_recall(spark, vectors, monkeypatch):
    monkeypatch.setattr("llm.embedding_dedup.VECTORS_PER_CELL", 20)
    got = near_duplicates(spark.createDataFrame(vectors, "vec_id long, embedding array<float>")).collect()
    assert sum(r.n_links for r in got) >= 0.99 * sum(r[1] for r in expected(vectors, 0.95))


@pytest.mark.parametrize("block", [4096, 40])
def test_default_loses_no_link_of_vectors_near_a_subspace(spark, monkeypatch, block):
    monkeypatch.setattr("llm.embedding_dedup.VECTORS_PER_CELL", 100)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 4)) @ rng.normal(size=(4, 128)) + 0.05 * rng.normal(size=(1500, 128))
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    unit = np.array([v for _, v in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), block=block).collect()
    assert linked.sum() > 3 * len(rows)
    assert [r.n_links for r in sorted(got)] == (linked.sum(1) - 1).tolist()


def test_no_vectors(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert near_duplicates(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect() == [(1, 0, 1, True)]
