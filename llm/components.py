"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of an edge that isn't a loop; label is the least node of its component.

    Both steps are a minimum per node, summed where rows lie, and a join with it. Each round is written to the shared folder, so a
    lost executor costs that round at most. Edges never reach the driver, which sees a count and a checksum.
    """
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    now, before = stored(now, "edges"), None
    for _ in range(most_rounds):
        mark = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if mark[0] == 0 or mark == before:
            # Stars: every node points to its component's least node.
            ends = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
            return ends.union(now.select(F.col("b"), F.col("b")).distinct())
        before = mark
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(least, F.col("a") == F.col("u")).select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).union(least.select("u", "m"))
        now = stored(small.where("a <> b").distinct(), "small-star")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def local_roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The least index of each index's component under the links i-j, for what one task holds."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], least)
        np.minimum.at(new, root[j], least)
        new = new[new]
        new = np.minimum(new, new[root])
        if (new == root).all():
            return root
        root = new
