"""Token counts by a compiled finite-state transducer.

A piece vocabulary whose pieces hold the space mark only in front, and no newline inside, never merges
across the borders before a run of spaces and around a newline. Tokenizing is then finite-state over
*units* (spaces with the word behind them; a newline): the transducer is back in its start state at
each border, and the transition over a unit emits that unit's number of tokens. Transitions are compiled
lazily with the tokenizer library, one per distinct unit, and kept in a bounded table.

A text is read in chunks. From an unknown entry state, a chunk is the map (head, n, tail): what it adds to an
open unit, tokens emitted between its first and last border, what it leaves open. Maps compose associatively, so
the chunks of a text are composed by a parallel scan over a tree; the counts need its upward half only (`reduce`), whose maps don't
outlive their round, so memory grows with the text and not with its square. `scan` gives the tokens before each chunk as well.

Text without spaces has borders too: between two characters that stand side by side in no piece, no token can reach across. Units of over
LONG_UNIT characters are cut there. What is left whole then, a run like `ababab` whose pairs are all pieces, costs the library's own memory, about 54
bytes a byte: 430 MB for 8 MB.

Texts of up to CHUNK_CHARS without double or leading spaces or the table's marks don't need chunks: their units are what lies
between spaces, and the counts of these are summed (`short`). That is the sum that their chunk map would give, for less.

Vocabularies without that property are counted text by text with the library, of which a warning tells.
"""

from __future__ import annotations

import os
import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import groups, utf8, without

UNIT = re.compile(r"\n| +[^ \n]*|[^ \n]+")
CHUNK_CHARS = 1 << 16
#: Transitions kept per Python worker, about 150 bytes each.
MAX_TRANSITIONS = 1_000_000
#: Longer units are cut between characters that no piece joins, and are not kept in the table.
LONG_UNIT = 1000


@dataclass(frozen=True)
class ChunkMap:
    """head and tail are open units, as slices in a row; without a border inside (n is None) all of the chunk is head."""

    head: tuple[str, ...]
    n: int | None = None
    tail: tuple[str, ...] = ()


class Transducer:
    def __init__(self, model_path: str, most: int = MAX_TRANSITIONS):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        # Borders hold if pieces and normaliser are local; the second line finds normalisers that change texts.
        self.local = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.local = self.local and self.library.normalize(" Ａ  ①\n x ") == "▁▁Ａ▁▁①\n▁x▁"
        if not self.local:
            warnings.warn(f"{model_path} merges or changes texts across borders: every text is counted as a whole by the library", stacklevel=2)
        self.most = most
        own = [i for i in range(len(pieces)) if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))]
        joined = {pieces[i][k : k + 2] for i in own for k in range(len(pieces[i]) - 1)}
        self.joined = np.unique([ord(a) << 21 | ord(b) for a, b in joined]).astype(np.int64)
        # Without byte pieces, unknown characters side by side become one token.
        self.single = None if any(self.library.is_byte(i) for i in range(len(pieces))) else np.unique([ord(pieces[i]) for i in own if len(pieces[i]) == 1])
        self.emitted: dict[str, int] = {}
        self.newline = len(self.library.encode("\n", num_threads=1))  # with the space mark in front
        self.space = 2 * self.newline - len(self.library.encode("\n\n", num_threads=1))

    def compile(self, units: list[str]) -> None:
        """Add the transitions for units that have none. In front of each stands a newline, which is a border."""
        new = set(units).difference(self.emitted)
        if len(self.emitted) + len(new) > self.most:
            self.emitted.clear()
            new = set(units)
        new = list(new)
        raw = ["\n" + (u[1:] if u[:1] in ("\x02", "\x03") else " " + u) for u in new]
        one = self.newline - self.space  # a newline alone
        for u, ids in zip(new, self.library.encode(raw, num_threads=1) if raw else [], strict=True):
            self.emitted[u] = len(ids) - self.newline + (one if u[:1] == "\x02" else 0)

    # Table keys: a word stands for one space and the word; \x02 for a newline and the word behind it;
    # \x03 for a unit as it is. Texts with two spaces in a row or such characters go by UNIT, as chunks do.

    def short(self, text: str) -> list[str] | None:
        if "  " in text or text[:1] == " " or "\x02" in text or "\x03" in text:
            return None
        return text.replace("\n", " \x02").split(" ") if text else []

    def units(self, text: str) -> list[str]:
        """Units between borders: spaces and newlines, and inside long ones where no piece joins two characters."""
        out: list[str] = []
        for unit in UNIT.findall(text):
            if len(unit) <= LONG_UNIT:
                out.append(unit)
                continue
            codes = np.frombuffer(unit.replace(" ", "▁").encode("utf-32-le"), np.uint32).astype(np.int64)
            pairs = codes[:-1] << 21 | codes[1:]
            apart = self.joined[np.minimum(np.searchsorted(self.joined, pairs), len(self.joined) - 1)] != pairs
            if self.single is not None:
                known = np.isin(codes, self.single)
                apart &= known[:-1] | known[1:]
            cuts = [0, *(np.flatnonzero(apart) + 1).tolist(), len(unit)]
            out += [unit[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
        return out

    def emit(self, units: list[str]) -> int:
        """Tokens of whole units."""
        keys = ["\x03" + u for u in units if len(u) <= LONG_UNIT]
        self.compile(keys)
        total = sum(map(self.emitted.__getitem__, keys))
        for u in units:
            if len(u) > LONG_UNIT:
                total += len(self.library.encode("\n" + u, num_threads=1)) - self.newline
        return total

    def chunk_map(self, chunk: str) -> ChunkMap:
        units = self.units(chunk)
        if len(units) < 2:
            return ChunkMap((chunk,))
        return ChunkMap((units[0],), self.emit(units[1:-1]), (units[-1],))

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """The map of two neighbouring chunks. Only the ends that meet are looked at: is there a border where they touch?"""
        left, right = (a.head if a.n is None else a.tail), b.head
        met = self._met(left, right)
        if a.n is None:
            if len(met) == 1:
                return ChunkMap(met[0], b.n, b.tail)
            if b.n is None:
                return ChunkMap(met[0], self._whole(met[1:-1]), met[-1])
            return ChunkMap(met[0], self._whole(met[1:]) + b.n, b.tail)
        if b.n is None:
            return ChunkMap(a.head, a.n + self._whole(met[:-1]), met[-1])
        return ChunkMap(a.head, a.n + self._whole(met) + b.n, b.tail)

    def _met(self, left: tuple[str, ...], right: tuple[str, ...]) -> list[tuple[str, ...]]:
        """left and right as units: one if no border lies where they touch. Each is one unit, or short enough to be cut anew."""
        if sum(map(len, left)) + sum(map(len, right)) <= 4 * LONG_UNIT:
            return [(u,) for u in self.units("".join(left + right))] or [()]
        if not left or not right:
            return [left or right]
        # A unit is spaces with the word behind them, or a newline, so a border needs a space or newline on the right, or a newline on the left.
        a, b = left[-1][-1], right[0][0]
        if a == "\n" or b == "\n" or (b == " " and a != " "):
            return [left, right]
        pair = ord("▁" if a == " " else a) << 21 | ord("▁" if b == " " else b)
        k = min(int(np.searchsorted(self.joined, pair)), len(self.joined) - 1)
        apart = self.joined[k] != pair and (self.single is None or ord(a) in self.single or ord(b) in self.single)
        return [left, right] if apart else [left + right]

    def _whole(self, units: list[tuple[str, ...]]) -> int:
        return self.emit(["".join(u) for u in units])

    def reduce(self, maps: list[ChunkMap]) -> ChunkMap:
        """The map of all chunks, by a tree; within a round all compositions are independent, and its maps replace those before."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def scan(self, maps: list[ChunkMap]) -> list[ChunkMap]:
        """Inclusive prefix scan in log2(n) rounds; within a round all compositions are independent."""
        step = 1
        while step < len(maps):
            maps = maps[:step] + [self.compose(maps[i - step], maps[i]) for i in range(step, len(maps))]
            step *= 2
        return maps

    def close(self, m: ChunkMap) -> int:
        """Tokens of a whole text with this map."""
        total = m.n or 0
        for end in [m.head] if m.n is None else [m.head, m.tail]:
            # Several slices that are long together have no border inside or where they touch.
            total += self._whole([end]) if len(end) > 1 and sum(map(len, end)) > 4 * LONG_UNIT else self.emit(self.units("".join(end)))
        return total

    def chunked(self, text: str, size: int = CHUNK_CHARS) -> int:
        text = " " + text  # the library puts a space in front of every text that isn't empty
        return self.close(self.reduce([self.chunk_map(text[i : i + size]) for i in range(0, len(text), size)]))

    def counts(self, texts: list[str]) -> list[int]:
        if not self.local:
            return [len(ids) for ids in self.library.encode(texts, num_threads=1)] if texts else []
        texts = [t.replace("▁", " ") for t in texts]  # the space mark itself reads as a space
        split = [self.short(t) if len(t) <= CHUNK_CHARS else None for t in texts]
        self.compile([u for units in split if units for u in units])
        get = self.emitted.__getitem__
        out = [None if units is None else sum(map(get, units)) for units in split]
        return [self.chunked(t) if n is None else n for t, n in zip(texts, out, strict=True)]


_compiled: dict[str, Transducer] = {}


def transducer(model_path: str) -> Transducer:
    """One per Python worker, so that its table outlives a task."""
    if model_path not in _compiled:
        _compiled[model_path] = Transducer(model_path)
    return _compiled[model_path]


def count_tokens(
    docs: DataFrame, text: str = "text", model: str = "piece_bpe_32k.model", model_path: str | None = None, limit: int = 4096
) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit (n_tokens > limit), row by row and without a shuffle.

    Counts are those of the tokenizer library for the whole text, without begin, end or added special tokens.
    A null text counts as empty: no bytes, no tokens, not over the limit. Equal rows stay equal rows. A column of
    docs with the name of a result is replaced; the text column is dropped. model_path overrides model's public place.
    """
    base = without(docs, "n_bytes", "n_tokens", "over_limit")
    rest = [c for c in base.columns if c != text]
    source = base.select(F.col(f"`{text}`").alias("\u0001text"), *[F.col(f"`{c}`") for c in rest])
    here = model_path or public_tokenizers.path(model)
    if os.path.exists(here):
        Transducer(here)  # for its warning, which workers give to their own logs only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model_path or public_tokenizers.path(model))
        for batch in batches:
            _, offsets, _ = utf8(batch.column(0))
            n_tokens = np.zeros(batch.num_rows, np.int64)
            for a, b in groups(offsets):
                n_tokens[a:b] = machine.counts([t or "" for t in batch.column(0).slice(a, b - a).to_pylist()])
            columns = [batch.column(i + 1) for i in range(len(rest))]
            columns += [pa.array(np.diff(offsets)), pa.array(n_tokens), pa.array(n_tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, [*rest, "n_bytes", "n_tokens", "over_limit"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name != text], "n_bytes long", "n_tokens long", "over_limit boolean"])
    return source.mapInArrow(run, schema)
