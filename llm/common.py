"""Helpers shared by the operators: shared folder, row keys, numpy views of Arrow text, word scanning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.session import work_folder

#: Texts are handled in groups of about this many bytes, which bounds what a task holds beside its Arrow batch.
GROUP_BYTES = 2 << 20


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """df written to the shared folder and read back: it cuts the lineage and survives lost executors."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without the columns an operator is about to add, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def whole_rows(df: DataFrame, *beside: Column) -> DataFrame:
    """df's rows as one struct `row`, with the given columns beside it, whose names can't clash with those inside."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *beside)


def parts_for(n_bytes: int, per_part: int, least: int = 1) -> int:
    """How many partitions keep each below per_part bytes."""
    return max(least, -(-int(n_bytes or 0) // per_part))


# -- texts in Arrow batches -----------------------------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, row starts and end, is null) of a string or binary column; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    null = np.asarray(column.is_null())
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and n else np.zeros(0, np.uint8)
    if n == 0:
        return data[:0], np.zeros(1, np.int64), null
    if null.any():  # a null may still own bytes
        sizes = np.where(null, 0, np.diff(offsets))
        if (np.diff(offsets) != sizes).any():
            data = np.concatenate([data[a : a + k] for a, k in zip(offsets[:-1], sizes, strict=True)])
            return data, np.concatenate([[0], np.cumsum(sizes)]), null
    return data[offsets[0] : offsets[-1]], offsets - offsets[0], null


def groups(offsets: np.ndarray, most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes; a longer row is a range of its own."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


# -- words -----------------------------------------------------------------------------------------

_code = np.arange(256)
#: Bytes of words: 0-9, a-z and all non-ASCII characters, after lower-casing A-Z.
LOWER = np.where((_code >= 65) & (_code <= 90), _code + 32, _code).astype(np.uint8)
IS_WORD = ((_code >= 48) & (_code <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_code >= 128)

_BLOCK = 1 << 18
_P, _Q = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95  # odd multipliers of the rolling hashes


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_P, _BLOCK + 1)
_DOWN = _powers(pow(_P, -1, 1 << 64), _BLOCK + 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of some texts: byte ranges within the texts' common buffer, row of each, hash of each."""

    data: np.ndarray  # lower-cased bytes
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    n_rows: int

    def window_hash(self, width: int) -> np.ndarray:
        """Hash of the `width` words from each word on; windows that leave their text are not masked."""
        n = len(self.hash) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = self.hash[:n].copy()
        for k in range(1, width):
            out *= np.uint64(_Q)
            out += self.hash[k : k + n]
        return mixed(out)

    def whole(self, width: int) -> np.ndarray:
        """Whether the `width` words from each word on lie in one text."""
        n = len(self.row) - width + 1
        return self.row[:n] == self.row[width - 1 :] if n > 0 else np.zeros(0, bool)

    def text(self, first: int, count: int) -> bytes:
        """Words joined by single spaces."""
        return b" ".join(self.data[self.start[i] : self.end[i]].tobytes() for i in range(first, first + count))


def scan_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of all texts. Bytes are handled in blocks, so that temporary arrays don't grow with a text."""
    n_rows, base, total = len(offsets) - 1, int(offsets[0]), int(offsets[-1] - offsets[0])
    data = LOWER[data[base : base + total]]
    edge = np.zeros(total + 1, bool)  # a text begins here
    edge[offsets - base] = True
    starts, ends, hashes = [], [], []
    at = 0
    while at < total:
        upto = min(total, at + _BLOCK)
        inside = IS_WORD[data[at:upto]]
        if upto < total and inside[-1] and IS_WORD[data[upto]] and not edge[upto]:
            gaps = np.flatnonzero(~inside)
            borders = np.flatnonzero(edge[at + 1 : upto]) + 1
            cut = max(int(gaps[-1]) + 1 if len(gaps) else 0, int(borders[-1]) if len(borders) else 0)
            if cut == 0:  # a word longer than a block
                rest = np.flatnonzero(~IS_WORD[data[upto:]] | edge[upto:total])
                upto += int(rest[0]) if len(rest) else total - upto
                inside = IS_WORD[data[at:upto]]
            else:
                upto = at + cut
                inside = inside[:cut]
        n = upto - at
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = inside[:-1]
        new = edge[at:upto]
        s = np.flatnonzero(inside & (~before | new))
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = inside[1:]
        after[:-1] &= ~new[1:]
        e = np.flatnonzero(inside & ~after) + 1
        up, down = (_UP, _DOWN) if n <= _BLOCK else (_powers(_P, n + 1), _powers(pow(_P, -1, 1 << 64), n + 1))
        total_hash = np.zeros(n + 1, np.uint64)
        np.cumsum((data[at:upto].astype(np.uint64) + np.uint64(1)) * up[:n], out=total_hash[1:])
        h = (total_hash[e] - total_hash[s]) * down[s]
        hashes.append(mixed(h + (e - s).astype(np.uint64)))
        starts.append(s + at)
        ends.append(e + at)
        at = upto
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    row = np.searchsorted(offsets - base, start, side="right") - 1 if len(start) else np.zeros(0, np.int64)
    return Words(data, start, end, row, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), n_rows)
