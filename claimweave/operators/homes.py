"""Updates of wide facts from many large sources, for one shuffle of the facts.

A chain of joins shuffles the facts once per source, wider each time. Here they are dealt once, by homes: runs of a few rows of the
table they lie in. What travels otherwise is narrow: each source is asked for the keys of the facts, once a key and home, and its
answers (the source's row, once a home that asked) are dealt as the homes are. All updates meet the facts there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

HOME = "_home"
#: Rows of a home are 2 to this power at most. A fact is compared with the answers of its home, so they are few; and a hot key asks once for so many facts.
HOME_BITS = 4
#: Rows of a part, as a rule. Its task holds the answers of its homes, which are no more than its rows, per source.
ROWS_PER_PART = 1 << 17


def with_homes(facts: DataFrame) -> DataFrame:
    """Facts with the number of their home. Not the same from run to run: to be written, and read from there."""
    return facts.withColumn(HOME, F.shiftright(F.monotonically_increasing_id(), HOME_BITS))


class Homes:
    """Facts that were written `with_homes`. Rows that lie together, as a visit's do, ask once; any order gives the same result."""

    def __init__(self, facts: DataFrame, rows_per_part: int = ROWS_PER_PART):
        self._rows = facts
        self.parts = max(facts.sparkSession.sparkContext.defaultParallelism, -(-facts.count() // rows_per_part))

    def dealt(self) -> DataFrame:
        return self._rows.repartition(self.parts, HOME)

    def meet(self, facts: DataFrame, key: str, *sources: tuple[DataFrame, str]) -> DataFrame:
        """A left join of dealt facts with sources, each by its own key, compared as text; the sources' keys are dropped.

        A source has at most one row per key. Null keys match nothing and ask nothing.
        """
        asked = self._rows.select(F.col(key).cast("string").alias("_key"), F.col(HOME).alias("_asked"))
        found, own = asked.where(F.col("_key").isNotNull()).distinct(), []
        for source, source_key in sources:
            own.append(f"_own{len(own)}")
            keyed = source.select(F.col(source_key).cast("string").alias(own[-1]), *[c for c in source.columns if c != source_key])
            found = found.join(keyed, F.col("_key") == F.col(own[-1]), "left")
        answers = found.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in own])).drop(*own)
        # The join is by home alone, as the facts lie, so it shuffles and sorts no facts; an equality of the keys would be part of it.
        same_key = F.col(key).cast("string").between(F.col("_key"), F.col("_key"))
        dealt = answers.repartition(self.parts, "_asked").hint("shuffle_hash")
        return facts.join(dealt, (F.col(HOME) == F.col("_asked")) & same_key, "left").drop("_asked", "_key")

    def join(self, left: DataFrame, right: DataFrame, on: dict[str, str], how: str = "left") -> DataFrame:
        """`meet` with the arguments of `key_join`, for updates."""
        ((key, right_key),) = on.items()
        if how != "left":
            raise ValueError("facts at home are updated by left joins")
        return self.meet(left, key, (right, right_key))
