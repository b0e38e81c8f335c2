"""The numpy scan of words against the pattern that defines them."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import common
from sample_texts import words

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aBz09 .,é\n\x00🙂Ω-", max_size=40)), max_size=12)


def check(values):
    data, offsets, null = common.utf8(pa.array(values, pa.string()))
    assert null.tolist() == [v is None for v in values]
    hashes = {}
    for a, b in common.groups(offsets, 50):
        found = common.scan_words(data, offsets[a : b + 1])
        spelled = [found.data[s:e].tobytes().decode() for s, e in zip(found.start, found.end, strict=True)]
        assert spelled == [w for v in values[a:b] for w in words(v)]
        assert np.bincount(found.row, minlength=b - a).tolist() == [len(words(v)) for v in values[a:b]]
        for w, h in zip(spelled, found.hash.tolist(), strict=True):
            assert hashes.setdefault(w, h) == h
    assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_are_those_of_the_pattern(values):
    check(values)


def test_texts_longer_than_a_block_and_words_longer_than_a_block(monkeypatch):
    monkeypatch.setattr(common, "_BLOCK", 64)
    check(["word " * 100, "x" * 500 + " y", None, "a" * 64, "b" * 63 + " " + "c" * 65, "é" * 40 + "." + "z" * 129])


def test_slices_and_nulls_that_own_bytes():
    whole = pa.array(["skip", "one two", None, "three"])
    data, offsets, null = common.utf8(whole.slice(1))
    assert bytes(data) == b"one twothree" and offsets.tolist() == [0, 7, 7, 12] and null.tolist() == [False, True, False]
    assert common.utf8(whole.slice(4))[1].tolist() == [0]
