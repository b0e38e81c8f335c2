import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
library = Tokenizer.from_file(PATH)
known = packing.Ids(PATH)
odd = st.lists(st.sampled_from(["a", "b", "'s", "'T", "É", "ñ", " ", "  ", "\n", "\t", "²", "1", "23", "_", "--", "<|endoftext|>", "<|", "İ", "ß", "Σ", "\xa0", "\x1c", "字", "DON'T", "\xad", "🙂", "é", ", ", ". ", "., ", "_, ", "', "]), max_size=14).map("".join)


@settings(max_examples=400, deadline=None)
@given(odd)
def test_ids_are_the_librarys(text):
    assert known.short_way
    assert np.frombuffer(known.of(text), known.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def round_trip(frame, pieces, window):
    """Every token of every document in exactly one piece; sequences gapless, full or a power of two."""
    want = sorted(((r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids + [1])) for r in frame.collect()), key=repr)
    rows = pieces.collect()
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u2")
        assert len(ids) == r.length > 0 and zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32
    chains = []
    left = {}
    for r in sorted(rows, key=lambda r: r.start):
        left.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for key, own in left.items():
        # Rows that repeat an id and a length are told apart by joining pieces end to start.
        n = sum(r.length for r in own) // key[1]
        assert sum(r.length for r in own) == n * key[1]
        if n == 1:
            assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
            chains.append((key[0], tuple(np.frombuffer(b"".join(bytes(r.ids) for r in own), "<u2").tolist())))
        else:
            chains += [w for w in want if w[0] == key[0] and len(w[1]) == key[1]]
    assert sorted(chains, key=repr) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        total = sum(r.length for r in own)
        assert total <= window and total & (total - 1) == 0
    return sequences


def test_every_token_is_packed_once(docs, no_docs):
    round_trip(docs, packing.pack(docs, window=256), 256)
    round_trip(docs, packing.pack(docs, window=64, tokens_per_partition=3000), 64)
    assert packing.pack(no_docs).count() == 0


def test_neighbours_share_windows(spark, monkeypatch):
    topics = [["".join(chr(97 + (t * 7 + k * 5 + x * x) % 26) for x in range(7)) for k in range(12)] for t in range(10)]
    rows = [(i, " ".join(topics[i % 10][(i * 7 + k) % 12] for k in range(10))) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sequences = round_trip(frame, packing.pack(frame, window=512), 512)
    topics_in = [len({r.doc_id % 10 for r in own}) for own in sequences.values() if len(own) >= 4]
    assert np.mean(topics_in) < 3  # all ten, if dealt at random
    table = packing.sequences(packing.pack(frame, window=512))
    assert table.agg({"n_tokens": "sum"}).first()[0] == sum(r.length for own in sequences.values() for r in own)


def test_shard_scores_are_bm25():
    import pyarrow as pa

    texts = ["red apple pie", "apple tart apple", "blue sky", "sky and pie and sky"]
    column = pa.array([known.of(t) for t in texts])
    ends = known.ends_word
    idf = np.full(1 << packing.SLOTS_BITS, 2.0)
    shard = packing.Shard(column, idf, 3.0, ends, known.dtype)
    score = lambda tf, n: 2.0 * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / 3.0))
    unused = np.array([False, True, True, True])
    got = shard.neighbours(0, unused).tolist()
    assert score(2, 3) > score(1, 5) and got == [1, 3]
    assert shard.neighbours(2, np.array([True, True, False, True])).tolist() == [3]


def _added(packer, texts):
    import pyarrow as pa

    shard = packing.Shard(pa.array([known.of(t) for t in texts]), np.full(1 << packing.SLOTS_BITS, 2.0), 3.0, known.ends_word, known.dtype)
    packer.add(shard, [[t, 0, np.frombuffer(known.of(t), known.dtype), 0] for t in texts], known.ends_word)
    return shard


def test_all_words_and_all_neighbours_count():
    common = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rest = [f"{w} cat" for w in common.split() for _ in range(4)]
    shard = _added(packing._Packer(100_000, 0, known.dtype), [common + " apple", *rest, "apple"])
    assert sorted(shard.neighbours(0, np.arange(66) > 0).tolist()) == list(range(1, 66))


def test_an_open_window_is_searched_on_with_its_seed():
    size = lambda *texts: sum(len(known.of(t)) // 2 for t in texts)
    packer = packing._Packer(size("apple pie", "red apple", "blue sky"), 0, known.dtype)
    _added(packer, ["apple pie"])
    _added(packer, ["blue sky", "green sky", "red apple"])  # the next shard: its tail with the seed's word comes first
    assert packer.rows["doc_id"][:2] == ["apple pie", "red apple"]
    packer = packing._Packer(size("apple pie", "blue sky", "green sky"), 0, known.dtype)
    _added(packer, ["apple pie", "blue sky", "old tree", "green sky"])  # no more neighbours: the next tail is the seed
    assert packer.rows["doc_id"][:3] == ["apple pie", "blue sky", "green sky"]
