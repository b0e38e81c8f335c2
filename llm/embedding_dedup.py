"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside cells, one representative per group.

Equal vectors are one class first. Centroids are fitted on a bounded sample. Every vector lies in the cell of its nearest
centroid and also visits each lower-numbered cell whose border is within reach. Vectors with cosine c are at most
r = sqrt(2 - 2c) apart on the unit sphere, so a neighbour can lie in another cell only if the plane between the two centroids is
at most r away. Every such cell is visited, so no link is lost. In high
dimensions that is most cells of a lower number: the work nears that of comparing all, each pair still once. `sigmas` is a bound
that loses links for fewer visits, on request only: it takes differences as evenly spread over all d dimensions,
so that their part along a plane's normal has a spread of r / sqrt(d), and vectors near a subspace have a larger one.

A cell's own vectors and its visitors are cut into blocks, and a task multiplies a block of its own vectors with another block; visitors
never meet each other. Cells are kept as numbers beside each vector, and only the shuffle to the tasks copies vectors. A task gives back a link count and one edge per vector, never
the pairs. Groups are the components of these edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import stored
from llm.components import components, local_roots

LEAST_COSINE = 0.95
#: Vectors to fit centroids on at most, about.
SAMPLE = 20_000
VECTORS_PER_CELL = 2_000
MAX_CELLS = 2_048
BLOCK = 4_096
SIGMAS = None


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """k unit centroids of unit vectors; a cell that runs empty takes the vector farthest from its centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        sims = x @ c.T
        home = sims.argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        norm = np.linalg.norm(total, axis=1)
        empty = norm < 1e-12
        if empty.any():
            far = np.argsort(sims[np.arange(len(x)), home])[: int(empty.sum())]
            total[np.flatnonzero(empty)[: len(far)]] = x[far]
            norm = np.maximum(np.linalg.norm(total, axis=1), 1e-300)
        c = total / norm[:, None]
    return c


def usable(v: Column) -> Column:
    """Vectors without null, infinite or NaN components that are not zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten()).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _fitted_cells(classes: DataFrame, sample: int) -> dict[int, np.ndarray]:
    """Centroids of each dimension: one job for all, and one task per dimension, whose vectors `sample` bounds. The driver gets centroids only."""

    def fit(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("uid")
        n = table["n"][0].as_py()
        c = spherical_kmeans(unit(_matrix(table["vector"].combine_chunks())), min(MAX_CELLS, -(-n // VECTORS_PER_CELL)))
        return pa.table({"dim": table["dim"][:1], "centroids": [np.ascontiguousarray(c, np.float64).tobytes()]})

    sizes = classes.groupBy("dim").agg(F.count("*").alias("n"))  # a row per dimension
    drawn = classes.join(sizes, "dim").where((F.col("n") <= sample) | (F.pmod(F.xxhash64("uid"), F.col("n")) < sample))
    fitted = drawn.select("dim", "n", "uid", "vector").groupBy("dim").applyInArrow(fit, "dim int, centroids binary").collect()
    cells = {r.dim: np.frombuffer(bytes(r.centroids)).reshape(-1, r.dim) for r in fitted}
    # A hash may draw nobody of a dimension; its vectors are one cell then.
    return cells | {r.dim: np.eye(1, r.dim) for r in sizes.select("dim").collect() if r.dim not in cells}


def link_classes(classes: DataFrame, least_cosine: float = LEAST_COSINE, sample: int = SAMPLE, block: int = BLOCK, sigmas: float | None = SIGMAS) -> DataFrame:
    """(uid, n, root) parts for classes (uid, dim, vector, members): n sums the members of linked classes, root is a linked uid.

    A class has a row for each task that found links of it. Vectors of different dimensions are never compared.
    """
    cells = _fitted_cells(classes, sample)
    # Centroids: at most MAX_CELLS of each dimension.
    shared = classes.sparkSession.sparkContext.broadcast(cells)
    apart = float(np.sqrt(2 - 2 * least_cosine)) + 1e-9

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column(1))
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                c = shared.value[dim]
                reach = apart if sigmas is None else apart * min(1.0, sigmas / dim**0.5)
                gap = np.maximum(np.linalg.norm(c[:, None, :] - c[None, :, :], axis=2), 1e-12) if len(c) <= 256 else None
                for a in range(0, own.num_rows, 2048):
                    part = own.slice(a, 2048)
                    x = unit(_matrix(part.column(2)))
                    sims = x @ c.T
                    home = sims.argmax(1)
                    best = sims[np.arange(len(x)), home]
                    # |p - q|^2 = 2 - 2 pq for unit centroids; the matrix is kept for few cells only
                    between = gap[home] if gap is not None else np.sqrt(np.maximum(2 - 2 * (c @ c.T)[home], 1e-24))
                    near = (best[:, None] - sims <= reach * between) & (np.arange(len(c)) < home[:, None])
                    near[np.arange(len(x)), home] = True
                    row, cell = np.nonzero(near)
                    ends = np.concatenate([[0], np.cumsum(near.sum(1))]).astype(np.int32)
                    cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(cell.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home.astype(np.int32)), cells], ["uid", "dim", "vector", "members", "own", "cells"])

    kind = classes.schema["vector"].dataType.simpleString()
    dealt = stored(classes.select("uid", "dim", "vector", "members").mapInArrow(deal, f"uid long, dim int, vector {kind}, members long, own int, cells array<int>"), "cells")
    visits = dealt.withColumn("cell", F.explode("cells")).withColumn("home", F.col("cell") == F.col("own")).drop("own", "cells")
    sizes = visits.groupBy("dim", "cell").agg(*[F.ceil(F.count_if(c) / block).cast("int").alias(n) for n, c in (("own_blocks", F.col("home")), ("guest_blocks", ~F.col("home")))])
    # One row per cell: at most MAX_CELLS of each dimension. Guests of a cell without own vectors link with nothing there.
    blocked = visits.join(F.broadcast(sizes.where("own_blocks > 0")), ["dim", "cell"])
    own, guests, dealt_by = F.col("own_blocks"), F.col("guest_blocks"), F.xxhash64("uid")
    blocked = blocked.withColumn("block", F.when(F.col("home"), F.pmod(dealt_by, own)).otherwise(own + F.pmod(dealt_by, F.greatest(guests, F.lit(1)))).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("home"), own + guests).otherwise(own) - 1)).alias("other")
    tasks = blocked.select("*", other).select(
        "dim", "cell", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), (F.col("block") > F.col("other")).alias("upper"), "uid", "vector", "members"
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("uid")
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        upper = np.asarray(table["upper"])
        p = np.arange(len(upper)) if lo == hi else np.flatnonzero(~upper)
        q = p if lo == hi else np.flatnonzero(upper)
        x = unit(_matrix(table["vector"].combine_chunks()))
        left, right = [], []
        for a in range(0, len(p), 512):
            i = p[a : a + 512]
            linked = x[i] @ x[q].T >= least_cosine
            if lo == hi:
                linked &= i[:, None] < q[None, :]
            r, c = np.nonzero(linked)
            left.append(i[r])
            right.append(q[c])
        i, j = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (left, right))
        uid, members = np.asarray(table["uid"]), np.asarray(table["members"])
        n = np.bincount(i, members[j], len(uid)) + np.bincount(j, members[i], len(uid))
        root = local_roots(i, j, len(uid))
        some = n > 0
        return pa.table({"uid": uid[some], "n": n[some].astype(np.int64), "root": uid[root[some]]})

    return tasks.groupBy("dim", "cell", "lo", "hi").applyInArrow(compare, "uid long, n long, root long")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", least_cosine: float = LEAST_COSINE, sample: int = SAMPLE, block: int = BLOCK, sigmas: float | None = SIGMAS) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept.

    n_links counts the other rows with cosine >= least_cosine in double precision, equal vectors included; component_id is
    the least vec_id reachable over links; kept marks the representatives. Vectors that are null, empty or zero or hold null or
    non-finite components link with nothing and are kept. A null vec_id never is a component's id unless there is no
    other, and such a row is kept only then. Rows that repeat a vec_id are rows of their own. Labels and other columns are not read.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    good = rows.where(usable(F.col("vector")))
    classes = good.groupBy("vector").agg(F.count("*").alias("members"), F.min("vec_id").alias("least_id"))
    classes = stored(classes.withColumns({"uid": F.monotonically_increasing_id(), "dim": F.size("vector")}), "vector-classes")
    links = stored(link_classes(classes, least_cosine, sample, block, sigmas), "vector-links")
    counts = links.groupBy("uid").agg(F.sum("n").alias("n"))
    groups = components(links.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    named = classes.select("uid", "vector", "members", "least_id").join(counts, "uid", "left").join(groups.withColumnRenamed("node", "uid"), "uid", "left")
    named = stored(named.withColumn("label", F.coalesce("label", "uid")), "vector-groups")
    ids = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = named.join(ids, "label").select("vector", "component_id", (F.coalesce("n", F.lit(0)) + F.col("members") - 1).alias("n_links"))
    # Null vectors match nothing, as they should; rows with unusable vectors have no class either.
    out = rows.join(named, "vector", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


LINKS_SQL = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {LEAST_COSINE}
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN least l ON vec_id = l.a LEFT JOIN counts c ON vec_id = c.a
"""
