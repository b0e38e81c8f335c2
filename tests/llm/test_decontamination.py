import hashlib

import pytest

from llm import decontamination
from sample_texts import awkward_texts, prose, words


@pytest.fixture(scope="module")
def benchmark(spark):
    base = [t for t in awkward_texts() if t and len(t) > 300]
    items = [(10, " ".join(base[0].split(" ")[5:40])), (2, base[1].upper()), (2, base[2]), (3, "one two"), (4, None), (5, "..."), (None, base[3]), (10, " ".join(base[0].split(" ")[5:40])), (7, prose(1234, 50))]
    return spark.createDataFrame(items, "item_id long, text string")


def windows(benchmark):
    out = {}
    for r in benchmark.collect():
        w = words(r.text)
        for i in range(max(1, len(w) - 9) if w else 0):
            out.setdefault(tuple(w[i : i + 10]), set()).add(None if r.item_id is None else str(r.item_id))
    return out


def expected(text, known):
    w = words(text)
    hit, items = set(), set()
    for n in {len(k) for k in known}:
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in known:
                hit.update(range(i, i + n))
                items |= known[tuple(w[i : i + n])] - {None}
    return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("most", [decontamination.BROADCAST_BYTES, 4000])
def test_report_matches_brute_force_in_one_pass_or_many(docs, benchmark, most):
    known = windows(benchmark)
    got = decontamination.report(docs, benchmark, most=most).drop("spans").collect()
    want = [(r.doc_id, *expected(r.text, known)) for r in docs.collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(r.n_hit for r in got) and any(not r.n_hit for r in got)


def test_empty_tables(docs, no_docs, benchmark, spark):
    assert decontamination.report(no_docs, benchmark).count() == 0
    clean = decontamination.report(docs, benchmark.limit(0))
    assert clean.where("contaminated OR n_items > 0").count() == 0 and clean.count() == docs.count()


def test_spans_are_cut_and_clean_documents_stay(docs, benchmark):
    known = windows(benchmark)
    out = decontamination.decontaminate(docs, benchmark)
    assert out.columns == docs.columns
    before = {(r.doc_id, r.text): r for r in docs.collect() if not expected(r.text, known)[4]}
    after = {(r.doc_id, r.text): r for r in out.collect()}
    assert before.items() <= after.items()
    for r in out.collect():
        assert not expected(r.text, {k: v for k, v in known.items() if len(k) == 10})[4]
        assert r.n_chars is None or r.text is None or r.n_chars in (len(r.text), 1, 30)
    assert decontamination.decontaminate(docs, benchmark, drop_share=0).count() == len([r for r in docs.collect() if not expected(r.text, known)[4]])


@pytest.mark.parametrize("most", [decontamination.BROADCAST_BYTES, 4000])
def test_columns_named_like_the_scans_stay(docs, benchmark, most):
    named = docs.selectExpr("*", "'h' AS __hits", "5 AS __n_words", "true AS hit", "1 AS row", "2 AS hits")
    out = decontamination.decontaminate(named, benchmark, most=most)
    assert out.columns == named.columns
    other = ["__hits", "__n_words", "hit", "row", "hits"]
    assert {tuple(r) for r in out.select(*other).collect()} == {("h", 5, True, 1, 2)}
    assert sorted(map(repr, out.select("doc_id", "text", "n_chars").collect())) == sorted(map(repr, decontamination.decontaminate(docs, benchmark).select("doc_id", "text", "n_chars").collect()))
