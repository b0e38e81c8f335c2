"""Embedding whitening by incremental eigendecomposition.

1. Vectors are put on an integer grid; each distinct grid vector once is the *fit list*, a written table.
2. Each task of the fit list keeps the spectrum of the scatter matrix around its own mean, and takes in block after block. A block is centred
   and rotated to at most `dim` rows of equal scatter; each row, and the shift between both means, is a rank-one update: its eigenvalues are the
   roots of a secular equation, after components that hardly change and equal eigenvalues are deflated.
3. The tasks' spectra are combined in a tree of fixed fan-in, each as successive rank-one updates by its scaled eigenvectors and the shift of means.
4. Rayleigh-Ritz refinement: one more pass over the fit list sums, per task, the products of the exactly centred vectors projected on that
   basis. The small projected problem gives eigenvalues and vectors to double precision, free of the updates' accumulated error.
5. A last pass measures the covariance of the whitened fit list; then all vectors are projected, without a shuffle.

What goes through the driver is a few dim x dim matrices, whatever the number of rows.

Defined results. Vectors that are null or hold null or non-finite entries are dropped; repeated rows stay repeated rows and count once in the fit.
Vectors of another length are a space of their own, with a fit of its own. Entries beyond 2^46 count as 2^46. Components without variance
(below 1e-12 of the first) can't be whitened and are left out, so a space of one distinct vector has no rows; neither has an empty table.
deviation is null where it does not fit a long. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BLOCK = 2048
FAN_IN = 16
_MOST = float(1 << 46)
_EPS = np.finfo(float).eps

# -- rank-one updates ------------------------------------------------------------------------------------


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + z z', d ascending and distinct, no z zero: (origin, offset), with each root at d[origin] + offset.

    The function 1 + sum z²/(d - x) rises from pole to pole. A root is measured from the closer one of its poles. An iteration keeps that
    pole's term as it is and the rest as a line, which leaves a quadratic equation; where that leaves the bracket, the bracket is halved.
    """
    k, z2 = len(d), z * z
    top = np.append(d[1:], d[-1] + z2.sum())
    gap = top - d
    middle = 1 + (z2 / (d[None, :] - (d + gap / 2)[:, None])).sum(1)
    left = middle >= 0
    left[-1] = True
    origin = np.where(left, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    delta = d[None, :] - d[origin][:, None]
    low, high = np.where(left, 0.0, -gap / 2), np.where(left, np.where(np.arange(k) == k - 1, gap * (1 + 4 * _EPS), gap / 2), 0.0)
    x, own, todo = (low + high) / 2, z2[origin], np.arange(k)
    for _ in range(100):
        at, p = x[todo], own[todo]
        far = delta[todo] - at[:, None]
        terms = z2 / far
        slopes = terms / far
        terms[np.arange(len(todo)), origin[todo]] = slopes[np.arange(len(todo)), origin[todo]] = 0
        rest, slope = 1 + terms.sum(1), slopes.sum(1)
        value = rest - p / at
        noise = _EPS * (1 + np.abs(terms).sum(1) + np.abs(p / at))
        low[todo], high[todo] = np.where(value < 0, at, low[todo]), np.where(value > 0, at, high[todo])
        b, right = rest - slope * at, ~left[todo]
        b[right] *= -1  # mirrored, so that the wanted root is the positive one
        root = np.sqrt(b * b + 4 * slope * p)
        new = np.where(b > 0, 2 * p / (b + root), (root - b) / (2 * slope + (slope == 0)))
        new[right] *= -1
        done = (np.abs(value) <= noise) | (np.abs(new - at) <= 2 * _EPS * np.abs(at))
        inside = (new > low[todo]) & (new < high[todo])
        x[todo] = np.where(done, at, np.where(inside, new, (low[todo] + high[todo]) / 2))
        todo = todo[~done]
        if not len(todo):
            break
    return origin, x


def rank_one(d: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of q diag(d) q' + v v'."""
    z = q.T @ v
    norm = np.sqrt(z @ z)
    tol = 8 * _EPS * max(np.abs(d).max(initial=0), norm * norm)
    live = np.abs(z) * norm > tol
    # Of two live components with equal eigenvalues, a rotation leaves one.
    while True:
        order = np.flatnonzero(live)
        order = order[np.argsort(d[order], kind="stable")]
        close = np.flatnonzero(np.diff(d[order]) <= tol)
        if not len(close):
            break
        q, z, d = q.copy(), z.copy(), d.copy()
        for k in close:
            i, j = order[k], order[k + 1]
            r = np.hypot(z[i], z[j])
            c, s = z[j] / r, z[i] / r
            q[:, i], q[:, j] = c * q[:, i] - s * q[:, j], s * q[:, i] + c * q[:, j]
            d[i], d[j] = c * c * d[i] + s * s * d[j], s * s * d[i] + c * c * d[j]
            z[i], z[j], live[i] = 0, r, False
    at = order
    if not len(at):
        order = np.argsort(d, kind="stable")
        return d[order], q[:, order]
    dl, zl = d[at], z[at]
    origin, x = secular_roots(dl, zl)
    # Weights for which these roots are exact keep the vectors orthogonal.
    away = x[:, None] - (dl[None, :] - dl[origin][:, None])  # root i - pole j
    gaps = dl[:, None] - dl[None, :]
    np.fill_diagonal(gaps, 1)
    ratio = np.ones_like(gaps)
    lower, upper = np.tril_indices(len(at), 0), np.triu_indices(len(at), 1)
    ratio[upper] = away[upper] / gaps[upper]  # i < j
    shifted = (lower[0][lower[0] + 1 < len(at)], lower[1][lower[0] + 1 < len(at)])
    ratio[shifted] = away[shifted] / gaps[shifted[0] + 1, shifted[1]]  # i >= j, against the next pole
    ratio[-1] = away[-1]
    weight = np.sqrt(np.abs(ratio.prod(0))) * np.sign(zl)
    vectors = weight[None, :] / -away
    vectors /= np.sqrt((vectors**2).sum(1))[:, None]
    d, q = d.copy(), q.copy()
    d[at] = dl[origin] + x
    q[:, at] = q[:, at] @ vectors.T
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


@dataclass
class Spectrum:
    """Number, mean and scatter (around that mean) of some vectors; the scatter by its eigenvalues and eigenvectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(dim: int) -> Spectrum:
        return Spectrum(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def _take(self, rows: np.ndarray, n: int, mean: np.ndarray) -> None:
        for row in rows:
            self.values, self.vectors = rank_one(self.values, self.vectors, row)
        total = self.n + n
        shift = mean - self.mean
        if self.n and n:
            self.values, self.vectors = rank_one(self.values, self.vectors, np.sqrt(self.n * (n / total)) * shift)
        self.mean, self.n = self.mean + shift * (n / total), total

    def add(self, block: np.ndarray) -> None:
        mean = block.mean(0)
        centred = block - mean
        self._take(np.linalg.qr(centred, mode="r") if len(block) > block.shape[1] else centred, len(block), mean)

    def merge(self, other: Spectrum) -> None:
        if other.n:
            own = other.values > 0
            self._take((other.vectors[:, own] * np.sqrt(other.values[own])).T, other.n, other.mean)


# -- tasks -----------------------------------------------------------------------------------------------


def grid(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(id, x) of the usable vectors: x is floor(scale * entry) + shift as longs."""
    entries = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    on = F.transform("v", lambda c: F.floor(F.least(F.greatest(c * float(scale), F.lit(-_MOST)), F.lit(_MOST))).cast("long") + F.lit(shift).cast("long"))
    return embeddings.select(F.col(f"`{vec_id}`").alias("id"), entries.alias("v")).where(F.col("v").isNotNull() & ~bad).select("id", on.alias("x"))


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows, matrix of longs) of each vector length in a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets).astype(np.int64)
    values, sizes = np.asarray(column.values), np.diff(offsets)
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        if dim:
            yield dim, rows, values[offsets[rows][:, None] + np.arange(dim)]


_STATE = "dim long, part long, state array<binary>"


def _states(states: dict[int, list[bytes]], part: int) -> pa.RecordBatch:
    columns = [pa.array(list(states), pa.int64()), pa.array([part] * len(states), pa.int64()), pa.array(list(states.values()), pa.list_(pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, ["dim", "part", "state"])


def _summed(fit: DataFrame, start: Callable, step: Callable, out: Callable, fold: Callable) -> dict[int, list[bytes]]:
    """Per vector length, a state over the whole fit list: start(dim), step(state, matrix) per block, out(state) per task, then fold in a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[int, object] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch.column(0)):
                state = states.setdefault(dim, start(dim))
                for a in range(0, len(x), BLOCK):
                    step(state, x[a : a + BLOCK])
        yield _states({dim: out(s) for dim, s in states.items()}, TaskContext.get().partitionId())

    def join(table: pa.Table) -> pa.Table:
        dim = table["dim"][0].as_py()
        order = np.argsort(np.asarray(table["part"]), kind="stable").tolist()
        return pa.Table.from_batches([_states({dim: fold(dim, (table["state"][i].as_py() for i in order))}, table["part"][order[0]].as_py() // FAN_IN)])

    level = stored(fit.select("x").mapInArrow(run, _STATE), "spectra")
    most = level.agg(F.max("part")).first()[0] or 0
    while most:
        level = level.groupBy("dim", F.floor(F.col("part") / FAN_IN).alias("group")).applyInArrow(join, _STATE)
        most //= FAN_IN
    return {r.dim: [bytes(b) for b in r.state] for r in level.collect()}  # one row per vector length


@dataclass
class Space:
    """What is known of the vectors of one length. sums are exact, of x - shift."""

    n: int
    sums: list[int]
    basis: np.ndarray
    values: np.ndarray | None = None
    trace: float = 0.0
    error: float = 0.0

    def offsets(self, x: np.ndarray, shift: int) -> np.ndarray:
        """n * x - S, exact: as longs where their squares' sum surely fits, else as Python's integers."""
        most = self.n * int(np.abs(x - shift).max(initial=0)) + max(map(abs, self.sums), default=0)
        if most * most * max(len(self.sums), 1) < 1 << 62:
            return self.n * (x - shift) - np.array(self.sums, np.int64)
        return (x - shift).astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray, shift: int) -> np.ndarray:
        return self.offsets(x, shift).astype(np.float64) / self.n


def _spectra(fit: DataFrame, shift: int) -> dict[int, Space]:
    def start(dim):
        return [Spectrum.empty(dim), np.zeros(dim, np.int64), np.zeros(dim, np.int64)]

    def step(state, x):
        u = x - shift
        state[0].add(u.astype(np.float64))
        state[1] += (u >> 24).sum(0)
        state[2] += (u & ((1 << 24) - 1)).sum(0)

    def out(state):
        s, high, low = state
        return [np.int64(s.n).tobytes(), s.mean.tobytes(), s.values.tobytes(), s.vectors.tobytes(), high.tobytes(), low.tobytes()]

    def read(dim, blobs):
        n, mean, values, vectors, high, low = blobs
        s = Spectrum(int(np.frombuffer(n, np.int64)[0]), np.frombuffer(mean), np.frombuffer(values), np.frombuffer(vectors).reshape(dim, dim))
        return [s, np.frombuffer(high, np.int64), np.frombuffer(low, np.int64)]

    def fold(dim, states):
        total = start(dim)
        for other in states:
            s, high, low = read(dim, other)
            total[0].merge(s)
            total[1], total[2] = total[1] + high, total[2] + low
        return out(total)

    spaces = {}
    for dim, blobs in _summed(fit, start, step, out, fold).items():
        s, high, low = read(dim, blobs)
        spaces[dim] = Space(s.n, [(a << 24) + b for a, b in zip(high.tolist(), low.tolist(), strict=True)], np.linalg.qr(s.vectors[:, ::-1])[0])
    return spaces


def _products(fit: DataFrame, spaces: dict[int, Space], shift: int, scaled: bool) -> dict[int, np.ndarray]:
    """Per space, the covariance of the centred fit list on the basis, over the root of its eigenvalues if scaled."""
    shared = fit.sparkSession.sparkContext.broadcast(spaces)

    def start(dim):
        k = shared.value[dim].basis.shape[1]
        return [np.zeros((k, k)), np.zeros(k), dim]

    def step(state, x):
        space = shared.value[state[2]]
        y = space.centred(x, shift) @ space.basis
        if scaled:
            y /= np.sqrt(space.values)
        state[0] += y.T @ y
        state[1] += y.sum(0)

    def out(state):
        return [state[0].tobytes(), state[1].tobytes()]

    def fold(dim, states):
        total = None
        for a, b in states:
            total = [np.frombuffer(a) + (total[0] if total else 0), np.frombuffer(b) + (total[1] if total else 0)]
        return [total[0].tobytes(), total[1].tobytes()]

    result = {}
    for dim, (a, b) in _summed(fit, start, step, out, fold).items():
        mean = np.frombuffer(b) / spaces[dim].n
        result[dim] = np.frombuffer(a).reshape(len(mean), -1) / spaces[dim].n - np.outer(mean, mean)
    return result


def fit_spaces(fit: DataFrame, components: int = COMPONENTS, shift: int = SHIFT) -> dict[int, Space]:
    """Per vector length, the leading components of a fit list (x, distinct)."""
    spaces = _spectra(fit, shift)
    for dim, covariance in _products(fit, spaces, shift, scaled=False).items():
        space = spaces[dim]
        values, turn = np.linalg.eigh((covariance + covariance.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        k = int((values[:components] > 1e-12 * max(values[0], 0)).sum()) if values[0] > 0 else 0
        basis = space.basis @ turn[:, :k]
        space.basis, space.values, space.trace = basis / np.sqrt((basis**2).sum(0)), values[:k].copy(), float(np.trace(covariance))
    usable = {d: s for d, s in spaces.items() if len(s.values)}
    if usable:
        held = fit.where(F.size("x").isin([int(d) for d in usable]))
        for dim, covariance in _products(held, usable, shift, scaled=True).items():
            usable[dim].error = float(np.abs(covariance - np.eye(len(covariance))).max())
    return usable


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """Per usable vector and component: vec_id, component from 1, n, deviation, whitened, explained and identity_error."""
    rows = grid(embeddings, vec_id, vector, scale, shift)
    fit = stored(rows.select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit-list")
    spaces = fit_spaces(fit, components, shift)
    shared = embeddings.sparkSession.sparkContext.broadcast(spaces)
    names = [vec_id, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _by_length(batch.column(1)):
                space = shared.value.get(dim)
                if space is None:
                    continue
                for a in range(0, len(x), BLOCK):
                    own = space.offsets(x[a : a + BLOCK], shift)
                    deviation = (own * own).sum(1)
                    if own.dtype == object:
                        deviation = [v if v < 1 << 63 else None for v in deviation.tolist()]
                    white = (own.astype(np.float64) / space.n) @ space.basis / np.sqrt(space.values)
                    k, m = white.shape[1], len(white)
                    each = np.repeat(np.arange(m), k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(np.repeat(at[a : a + BLOCK], k))),
                            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                            pa.array(np.full(m * k, space.n)),
                            pa.array(deviation, pa.int64()).take(pa.array(each)),
                            pa.array(white.reshape(-1)),
                            pa.array(np.tile(space.values / space.trace, m)),
                            pa.array(np.full(m * k, space.error)),
                        ],
                        names,
                    )

    kind = embeddings.schema[vec_id].dataType.simpleString()
    return rows.mapInArrow(run, f"`{vec_id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
