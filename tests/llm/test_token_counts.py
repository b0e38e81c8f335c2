import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.token_counts import Transducer, count_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
library = sentencepiece.SentencePieceProcessor(model_file=PATH)
machine = Transducer(PATH)
odd = st.lists(st.sampled_from(["a", "b", "the", " ", "  ", "\n", "\x02", "\x03", "▁", "é", "<s>", "\t", "\r\n", "　", "Ａ", "\0", "🙂"]), max_size=30).map("".join)


def test_the_vocabulary_is_local():
    assert machine.local


@settings(max_examples=300, deadline=None)
@given(odd)
def test_counts_are_the_librarys(text):
    assert machine.counts([text]) == [len(library.encode(text))]


@settings(max_examples=200, deadline=None)
@given(odd.map(lambda t: t.replace("▁", "")).filter(bool), st.integers(1, 9))
def test_chunk_maps_compose(text, size):
    assert machine.chunked(text, size) == len(library.encode(text))


unbroken = st.lists(st.sampled_from(["a", "ing", "q7", "xZ", "the", "0", "é", "漢字", "🙂", "ß", "▁", "ab" * 40, "\n", " ", "  ", "%%", "\t"]), min_size=200, max_size=1500)


@settings(max_examples=60, deadline=None)
@given(unbroken.map("".join), st.sampled_from([50, 700, 1500, 5000]))
def test_long_units_are_cut_where_no_piece_joins(text, size):
    text = text.replace("▁", " ")
    assert machine.chunked(text, size) == len(library.encode(text))


def test_memory_grows_with_an_unbroken_text():
    import random
    import tracemalloc

    from llm import token_counts

    rng = random.Random(5)
    peaks = []
    for mb in (1, 4):
        text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=mb << 20))
        fresh = Transducer(PATH, most=20_000)
        want = len(library.encode(text))
        tracemalloc.start()
        assert fresh.chunked(text) == want
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 8 * peaks[0] and peaks[1] < 60 << 20
    whole = "ab" * 100_000  # no border anywhere
    assert machine.chunked(whole, token_counts.CHUNK_CHARS) == len(library.encode(whole))


def test_a_full_table_starts_anew():
    small = Transducer(PATH, most=5)
    texts = ["one two three four", "five six seven", "one two"] * 3
    assert [small.counts([t])[0] for t in texts] == [len(library.encode(t)) for t in texts]


def test_rows_nulls_and_clashing_columns(docs, no_docs):
    got = count_tokens(docs.withColumnRenamed("n_hit", "n_tokens"), limit=100).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in docs.collect()]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert count_tokens(no_docs).count() == 0


def test_a_vocabulary_that_is_not_local_is_reported(spark, monkeypatch):
    class Changed(sentencepiece.SentencePieceProcessor):
        def normalize(self, *args, **more):
            return ""

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Changed)
    with pytest.warns(UserWarning, match="by the library"):
        count_tokens(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
