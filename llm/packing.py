"""Packing of token sequences by lexical retrieval: BM25 neighbours of a seed document fill its window.

1. Each document is tokenized, and closed by an end id. Whole windows of a long document are sequences as they are; its rest, shorter
   than a window, is a *tail* to be packed.
2. Document frequencies of hashed words are counted over all tails; the table has a fixed number of slots.
3. Tails are dealt by range of a MinHash of their words, with ties broken by content, so lexical neighbours are likely to meet,
   copies in any number spread, and partitions are of even size.
4. A partition is read in shards of a bounded number of tails. Each shard has a BM25 inverted index; a seed's best unused neighbours, by
   all its words, are appended whole while they fit, and the next is cut to close the window. What is cut off remains in the pool.
   If no unused tail shares a word with the seed, the next tail goes in and is the seed from there on; an open window goes on into the
   next shard, which is searched with its seed first. At a partition's end the last tokens form sequences of powers of two. So no
   sequence needs padding.

Null and empty texts, long texts and ties: a document of nothing is its end id; a text of any length is cut into whole windows and one tail; equal
leads, equal contents and equal scores are ordered by content and id, rows equal in all that are interchangeable.

A shard's tails are the only ones that its seeds can meet: neighbours in other shards are out of reach.
"""

from __future__ import annotations

import re
import zlib

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import groups, mixed, stored, utf8

WINDOW = 2048
END_ID = 1
SLOTS_BITS = 18
SHARD_TAILS = 2048
TOKENS_PER_PARTITION = 8_000_000
K1, B = 1.2, 0.75
#: Pieces of text kept per Python worker with their ids, about 200 bytes each; twice as many at most.
MAX_KNOWN = 240_000

# How the vocabulary's file splits words, for characters below U+0250, which its normaliser only lower-cases.
_PART = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_MARKS = re.compile(r"[.,](?<=(?:[^\w ]|[_İ]).) ")
_FIRST_WIDE = "\u0250"
_WIDE = re.compile("[^\x00-\u024f]")


class _Table(dict):
    """Ids of pieces, computed when first asked for. The table before is kept behind it, so frequent pieces live on."""

    def __init__(self, compute, old: dict[str, bytes]):
        super().__init__()
        self.compute, self.old = compute, old

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        self[piece] = found = self.compute(piece) if found is None else found
        return found


class Ids:
    """Ids, as bytes, of texts by way of their pieces between spaces, which no token crosses; found by the library, then remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.model = self.library.model
        self.packed = [k.to_bytes(self.dtype.itemsize, "little") for k in range(self.library.get_vocab_size())]
        self.words: dict[str, bytes] = {}
        # The byte alphabet of byte-level vocabularies. Visible bytes stand for themselves, the others for characters from 256 on.
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.letters = {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.ends_word = np.zeros(1 << 16 if self.dtype.itemsize == 2 else self.library.get_vocab_size(), bool)
        for token, k in self.library.get_vocab().items():
            self.ends_word[k] = token.endswith("</w>")
        # The short way is taken only if it agrees with the library on a probe.
        probe = "don't THE Façade, x1²½ a_b--c!! naïve's ÀÉ. So, (a), b"
        self.table = _Table(self.piece, {})
        self.short_way = True
        self.short_way = self.of(probe) == self.whole(probe)

    def forget(self) -> None:
        """Give back the memory of remembered pieces."""
        self.table = _Table(self.piece, {})
        self.words.clear()

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def word(self, part: str) -> bytes:
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(letters)])

    def known_word(self, part: str) -> bytes:
        found = self.words.get(part)
        if found is None:
            if len(self.words) >= MAX_KNOWN // 2:
                self.words.clear()
            found = self.words[part] = self.word(part)
        return found

    def piece(self, piece: str) -> bytes:
        """By the library's own model, past its normaliser and splitter, which do nothing but lower-case and split here."""
        if piece.isalpha() and (piece.isascii() or max(piece) < _FIRST_WIDE):
            lower = piece.lower()
            return self.word(lower) if lower.isalpha() else self.whole(piece)
        if not piece.isprintable() or _WIDE.search(piece) or "<|" in piece:
            return self.whole(piece)
        piece = piece.lower()
        parts = _PART.findall(piece)
        return self.word(parts[0]) if len(parts) == 1 else b"".join(map(self.known_word, parts))

    def of(self, text: str) -> bytes:
        if not self.short_way:
            return self.whole(text)
        if len(self.table) >= MAX_KNOWN:
            self.table = _Table(self.piece, dict(self.table))
        text = text.replace("\n", " ")
        # Commas and stops behind a letter or digit are words of their own anyway; apart, the words before them are known more often.
        if not _MARKS.search(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        if text.isascii() or not _WIDE.search(text):
            text = text.lower()
        return b"".join(map(self.table.__getitem__, text.split(" ")))


_known: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    """One per Python worker."""
    if path not in _known:
        _known[path] = Ids(path)
    return _known[path]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _slots(ids: np.ndarray, rows: np.ndarray, ends_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of each word: a run of ids up to one that ends a word, hashed. rows: of each id."""
    if not len(ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    stop = ends_word[ids].copy()
    stop[:-1] |= rows[1:] != rows[:-1]
    stop[-1] = True
    ends = np.flatnonzero(stop)
    starts = np.concatenate([[0], ends[:-1] + 1])
    within = np.arange(len(ids)) - np.repeat(starts, ends - starts + 1)
    h = mixed(ids.astype(np.uint64) + (within.astype(np.uint64) << np.uint64(20)))
    return rows[starts], (mixed(np.add.reduceat(h, starts)) >> np.uint64(64 - SLOTS_BITS)).astype(np.int64)


def _words_of(ids: np.ndarray, sizes: np.ndarray, ends_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, times) of the distinct words of tails, given their ids one after the other."""
    row, slot = _slots(ids, np.repeat(np.arange(len(sizes)), sizes), ends_word)
    key, times = np.unique(row << SLOTS_BITS | slot, return_counts=True)
    return key >> SLOTS_BITS, key & ((1 << SLOTS_BITS) - 1), times


_PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def _batch(kind: pa.DataType, rows: dict[str, list], leads: np.ndarray | None = None) -> pa.RecordBatch:
    types = [kind, *[pa.int64()] * 6, pa.binary()]
    columns = [pa.array(rows[n], t) for n, t in zip(_NAMES, types, strict=True)]
    return pa.RecordBatch.from_arrays(columns if leads is None else [*columns, pa.array(leads)], _NAMES if leads is None else [*_NAMES, "lead"])


_COUNTS = -1  # the sequence_id of rows that carry a task's word counts
_SLICES = 64


def tokenized(docs: DataFrame, path: str, window: int) -> DataFrame:
    """Whole windows as finished pieces; each document's tail, a piece without a sequence_id; and, for each task, in how many tails
    each slot's words occur, in slices. The lead of a tail is the least-hashed slot of its words: tails that share most words
    are likely to share it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ids_of(path)
        sequence = 1 << 60 | TaskContext.get().partitionId() << 32
        counts, kind = np.zeros(1 << SLOTS_BITS, np.int64), None
        for batch in batches:
            _, offsets, _ = utf8(batch.column(1))
            kind = batch.column(0).type
            for a, b in groups(offsets):
                rows: dict[str, list] = {n: [] for n in _NAMES}
                tails, at = [], []
                for doc_id, text in zip(batch.column(0).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a).to_pylist(), strict=True):
                    ids = np.append(np.frombuffer(known.of(text or ""), known.dtype), np.array(END_ID, known.dtype))
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        full = len(piece) == window
                        if not full:
                            tails.append(piece)
                            at.append(len(rows["ids"]))
                        for n, v in zip(_NAMES, (doc_id, start, len(piece), _crc(piece) if full else None, len(ids), sequence if full else None, 0 if full else None, piece.tobytes()), strict=True):
                            rows[n].append(v)
                        sequence += full
                leads = np.zeros(len(rows["ids"]), np.int64)
                if tails:
                    row, slot, _ = _words_of(np.concatenate(tails), np.array([len(t) for t in tails]), known.ends_word)
                    counts += np.bincount(slot, minlength=len(counts))
                    own, first = np.unique(row, return_index=True)
                    hashed = (mixed(slot.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
                    leads[np.array(at)[own]] = np.minimum.reduceat(hashed, first)
                yield _batch(kind, rows, leads)
        if kind is not None:
            rows = {n: [None] * _SLICES for n in _NAMES} | {"start": list(range(_SLICES)), "length": [0] * _SLICES, "sequence_id": [_COUNTS] * _SLICES}
            yield _batch(kind, rows | {"ids": [v.tobytes() for v in counts.reshape(_SLICES, -1)]}, np.zeros(_SLICES, np.int64))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_PIECE}, lead long")


def word_frequencies(pieces: DataFrame) -> np.ndarray:
    """In how many tails each slot's words occur: the tasks' counts, summed by slice."""
    width = (1 << SLOTS_BITS) // _SLICES

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for v in table["ids"]:
            total += np.frombuffer(v.as_py(), np.int64)
        return pa.table({"slice": [table["start"][0].as_py()], "counts": [total.tobytes()]})

    summed = pieces.where(F.col("sequence_id") == _COUNTS).select("start", "ids").groupBy("start").applyInArrow(add, "slice long, counts binary")
    out = np.zeros((_SLICES, width), np.int64)
    for r in summed.collect():  # 64 rows, 2 MB together
        out[r.slice] = np.frombuffer(bytes(r.counts), np.int64)
    return out.reshape(-1)


class Shard:
    """A BM25 inverted index over some tails, from which neighbours are taken out as they are used."""

    def __init__(self, column: pa.Array, idf: np.ndarray, mean_words: float, ends_word: np.ndarray, dtype: np.dtype):
        data, offsets, _ = utf8(column)
        row, slot, times = _words_of(np.frombuffer(data.tobytes(), dtype), np.diff(offsets) // dtype.itemsize, ends_word)
        self.size = len(column)
        lengths = np.bincount(row, times, self.size)
        # The end id, which all tails hold, is no word to search by.
        word = slot != _slots(np.array([END_ID]), np.zeros(1, np.int64), ends_word)[1][0]
        row, slot, times = row[word], slot[word], times[word]
        weight = idf[slot] * times * (K1 + 1) / (times + K1 * (1 - B + B * lengths[row] / max(mean_words, 1e-9)))
        order = np.lexsort((row, slot))
        self.row, self.weight = row[order], weight[order]
        self.slots, self.first = np.unique(slot[order], return_index=True)
        self.last = np.append(self.first[1:], len(order))
        # The words of each tail, as numbers of slots.
        self.word, self.begin = np.searchsorted(self.slots, slot), np.searchsorted(row, np.arange(self.size + 1))

    def _best(self, words: np.ndarray, unused: np.ndarray) -> np.ndarray:
        if not len(words):
            return np.zeros(0, np.int64)
        ranges = list(map(slice, self.first[words].tolist(), self.last[words].tolist()))
        score = np.bincount(np.concatenate([self.row[r] for r in ranges]), np.concatenate([self.weight[r] for r in ranges]), self.size)
        found = np.flatnonzero(unused & (score > 0))
        return found[np.argsort(-score[found], kind="stable")]

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """All unused tails that share a word with the seed, best first."""
        return self._best(self.word[self.begin[seed] : self.begin[seed + 1]], unused)

    def neighbours_of(self, ids: np.ndarray, ends_word: np.ndarray, unused: np.ndarray) -> np.ndarray:
        """The same for a seed that isn't in the shard."""
        slots = np.unique(_slots(ids, np.zeros(len(ids), np.int64), ends_word)[1])
        return self._best(np.flatnonzero(np.isin(self.slots, slots)), unused)


class _Packer:
    """Fills windows from shard after shard of one partition."""

    def __init__(self, window: int, first_sequence: int, dtype: np.dtype):
        self.window, self.sequence, self.dtype = window, first_sequence, dtype
        self.open: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of the window being filled
        self.fill = 0
        self.seed = np.zeros(0, dtype)  # ids of the open window's seed
        self.rows: dict[str, list] = {n: [] for n in _NAMES}

    def close(self) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in self.open:
            for n, v in zip(_NAMES, (doc_id, start, len(ids), _crc(ids), doc_tokens, self.sequence, offset, ids.tobytes()), strict=True):
                self.rows[n].append(v)
            offset += len(ids)
        self.sequence, self.open, self.fill = self.sequence + 1, [], 0

    def add(self, shard: Shard, tails: list[list], ends_word: np.ndarray) -> None:
        """tails: [doc_id, start, ids, doc_tokens], changed in place as they are cut."""
        unused, at, sizes = np.ones(len(tails), bool), 0, np.array([len(t[2]) for t in tails])

        def take(i: int) -> None:
            doc_id, start, ids, doc_tokens = tails[i]
            space = self.window - self.fill
            self.open.append((doc_id, start, ids[:space], doc_tokens))
            self.fill += min(space, len(ids))
            if len(ids) > space:
                tails[i][1:3] = start + space, ids[space:]
                sizes[i] = len(ids) - space
            else:
                unused[i] = False
            if self.fill == self.window:
                self.close()

        def extend(neighbours: np.ndarray) -> None:
            first, waiting = self.sequence, None
            while len(neighbours):
                fits = sizes[neighbours] <= self.window - self.fill
                k = int(fits.argmax())
                if waiting is None and not fits[0]:
                    waiting = int(neighbours[0])
                if not fits[k]:
                    break
                take(int(neighbours[k]))
                if self.sequence != first:
                    return
                neighbours = neighbours[k + 1 :]
            if waiting is not None:
                take(waiting)

        if self.fill:
            extend(shard.neighbours_of(self.seed, ends_word, unused))
        while True:
            while at < len(tails) and not unused[at]:
                at += 1
            if at == len(tails):
                return
            seed, before = tails[at][2], self.sequence
            take(at)
            if self.sequence == before:
                self.seed = seed
                extend(shard.neighbours(at, unused))

    def finish(self) -> None:
        """The tokens of the last, open window as sequences of powers of two."""
        rest, self.open, left = self.open, [], self.fill
        self.fill = 0
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            while size:
                doc_id, start, ids, doc_tokens = rest[0]
                self.open.append((doc_id, start, ids[:size], doc_tokens))
                rest[0] = (doc_id, start + size, ids[size:], doc_tokens)
                if len(ids) <= size:
                    rest.pop(0)
                size -= min(size, len(ids))
            self.close()


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str = "word_bpe_49k.json", path: str | None = None, tokens_per_partition: int = TOKENS_PER_PARTITION) -> DataFrame:
    """Pieces of all documents in sequences of at most `window` tokens, none of which needs padding.

    docs needs doc_id and text; other columns are not read. Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and ids (little-endian, 2 bytes each for vocabularies below 65,536 ids, else 4). A null or empty text is its end id
    alone. Rows that repeat a doc_id are documents of their own. A document's pieces cover each of its tokens once.
    """
    path = path or public_tokenizers.path(vocabulary)
    pieces = stored(tokenized(docs, path, window), "tokenized")
    tails = pieces.where("sequence_id IS NULL")
    n, tokens = tails.agg(F.count("*"), F.sum("length")).first()
    frequency = word_frequencies(pieces)
    idf = np.log(1 + (n - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)
    mean_words = float(frequency.sum()) / max(n, 1)
    shared = docs.sparkSession.sparkContext.broadcast(idf)  # a fixed size, 2^18 slots

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ids_of(path)
        known.forget()  # a worker that tokenized before does not tokenize again
        ends, rarity = known.ends_word, shared.value
        packer, kind = _Packer(window, TaskContext.get().partitionId() << 32, known.dtype), None

        def flush() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, {n: [] for n in _NAMES}
            return _batch(kind, rows)

        for batch in batches:
            kind = batch.column(0).type
            for a in range(0, batch.num_rows, SHARD_TAILS):
                part = batch.slice(a, SHARD_TAILS)
                shard = Shard(part.column(3), rarity, mean_words, ends, known.dtype)
                own = zip(*[part.column(k).to_pylist() for k in range(4)], strict=True)
                packer.add(shard, [[doc_id, start, np.frombuffer(ids, known.dtype), size] for doc_id, start, size, ids in own], ends)
                yield flush()
        packer.finish()
        if kind is not None:
            yield flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    order = ["lead", F.crc32("ids"), "doc_id"]  # of which Spark samples some rows for the ranges
    parts = max(1, -(-int(tokens or 0) // tokens_per_partition))
    packed = tails.repartitionByRange(parts, *order).sortWithinPartitions(*order, "ids", "start").select("doc_id", "start", "doc_tokens", "ids").mapInArrow(fill, f"doc_id {kind}, {_PIECE}")
    return pieces.where("sequence_id >= 0").drop("lead").union(packed)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, pieces) with each sequence's pieces in order; a sequence holds at most a window's tokens."""
    own = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), own.alias("pieces"))
