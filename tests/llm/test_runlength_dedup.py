import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.runlength_dedup import RunLengthIndex, dedup
from sample_texts import awkward_texts, prose


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=40), min_size=1, max_size=12), st.integers(1, 12))
def test_index_finds_what_starts_earlier(strings, width):
    text = np.array([x for s in strings for x in (*[ord(c) + 1 for c in s], 0)], np.uint16)
    seen, want = set(), []
    for i in range(len(text) - width + 1):
        key = tuple(text[i : i + width].tolist())
        if 0 not in key:
            if key in seen:
                want.append(i)
            seen.add(key)
    index = RunLengthIndex(text)
    assert index.repeats(width).tolist() == want
    order = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert index.order.tolist() == order
    lengths = index.matching_lengths()
    for a, b in zip(order, order[1:], strict=False):
        x, y = text[a:].tolist(), text[b:].tolist()
        assert lengths[b] == next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))


def expected(rows, width):
    """rows of (id, text) in order; repeats of a row get the same result."""
    seen, out = {}, {}
    for key, text in rows:
        b = (text or "").encode()
        if (key, text) in out:
            continue
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - width + 1):
            if b[s : s + width] in seen:
                gone[s : s + width] = True
            seen.setdefault(b[s : s + width], s)
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[key, text] = (key, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return [out[r] for r in rows]


def check(frame, **options):
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    crc = {r.text: r.c for r in frame.selectExpr("text", "crc32(coalesce(text, '')) AS c").collect()}
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, crc[r[1]]))
    got = [tuple(r) for r in dedup(frame, **options).collect()]
    assert sorted(got, key=repr) == sorted(expected(rows, options.get("width", 100)), key=repr)
    return got


def test_documents_match_brute_force(docs, no_docs):
    assert any(r[2] for r in check(docs))
    assert dedup(no_docs).count() == 0


def test_shards_and_frequent_anchors_change_nothing(spark):
    line = "A line that many documents share, long enough to hold an anchor, short of the width. "
    texts = [prose(i, 12) + line + prose(i + 100, 12) for i in range(40)] + [prose(7, 60), prose(7, 60)[3:], "ab" * 150, "ab" * 150 + "c", None, ""]
    texts += [t[:150] + t for t in awkward_texts() if t and 400 < len(t) < 5000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    plain = check(frame)
    assert sorted(check(frame, hot_runs=16, bytes_per_shard=3000)) == sorted(plain)
    check(frame, width=40, k=9)


def test_text_that_stays(spark):
    text = prose(1, 80)
    frame = spark.createDataFrame([(1, text), (2, "head " + text + " tail")], "doc_id long, text string")
    kept = {r.doc_id: bytes(r.kept).decode() for r in dedup(frame, with_text=True).collect()}
    assert kept == {1: text, 2: "head  tail"}
