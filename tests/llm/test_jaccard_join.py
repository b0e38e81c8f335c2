import math

import pytest

from llm.jaccard_join import jaccard_links, keep_one, least_matches
from sample_texts import prose, words


def grams(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def expected(rows, threshold=0.8):
    sets, n = [grams(t) for _, t in rows], len(rows)
    links, root = [0] * n, list(range(n))
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    least = lambda k: (k is not None, k or 0)
    return [(k, min((rows[j][0] for j in range(n) if root[j] == root[i]), key=least), links[i]) for i, (k, _) in enumerate(rows)], root, sets


@pytest.fixture(scope="module")
def copies(spark, docs):
    """Near copies of graded similarity, in one large group and some small ones."""
    texts = []
    for g in range(4):
        base = prose(500 + g, 150).split(" ")
        for v in range(40 if g == 0 else 9):
            edited = list(base)
            for k in range(v % 7):
                edited[(v * 11 + k * 29) % len(base)] = f"edit{v}"
            texts.append(" ".join(edited))
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(1000, texts[0]), (1, texts[1])]
    return spark.createDataFrame(rows, "doc_id long, text string").union(docs.select("doc_id", "text")).repartition(4)


@pytest.mark.parametrize("block", [1024, 7])
def test_links_and_classes_match_brute_force(copies, block, monkeypatch):
    if block == 7:
        monkeypatch.setattr("llm.jaccard_join.SET_BLOCK", 7)
    rows = [(r.doc_id, r.text) for r in copies.collect()]
    want, *_ = expected(rows)
    got = [tuple(r) for r in jaccard_links(copies, block=block).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_one_row_of_each_group_stays(copies, docs, no_docs):
    rows = [(r.doc_id, r.text) for r in copies.collect()]
    _, root, sets = expected(rows)
    got = [(r.doc_id, r.text) for r in keep_one(copies).collect()]
    alone = sorted((r for r, s in zip(rows, sets, strict=True) if s is None), key=repr)
    assert sorted((r for r in got if grams(r[1]) is None), key=repr) == alone
    groups = {}
    for r, own, s in zip(rows, root, sets, strict=True):
        if s is not None:
            groups.setdefault(own, []).append(r)
    assert len(got) == len(alone) + len(groups)
    least = lambda r: (r[0] is not None, r[0] or 0)
    for members in groups.values():
        (kept,) = {r for r in members if r in got}
        assert least(kept) == min(map(least, members))
    named = docs.selectExpr("*", "1 AS __id", "2 AS __md5", "3 AS __all", "4 AS own_id", "5 AS row", "6 AS number", "7 AS every")
    kept = keep_one(named)
    assert kept.columns == named.columns
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in named.collect()} and kept.count() == keep_one(docs).count()
    assert keep_one(no_docs).count() == 0 and jaccard_links(no_docs).count() == 0


def test_bounds_are_the_posterior():
    for n, m in least_matches(0.8, 1e-6):
        below = sum(math.comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(m))
        assert below < 1e-6 <= below + math.comb(n + 1, m) * 0.8**m * 0.2 ** (n + 1 - m)
