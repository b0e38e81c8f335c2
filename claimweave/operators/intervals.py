"""Points in periods as an equi join: periods are cut into aligned day ranges whose lengths are powers of two.

A period of n days is at most 2 log2(n) such ranges (a segment tree's nodes), and a day lies in exactly one range per level. So a join of
days with periods needs a key per level from the one side and a few keys per period from the other, instead of a row for
each day of each period.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Ranges of up to 2^22 days cover all dates there are.
LEVELS = 23
_LEVEL_BITS = 40


def day_number(day: Column) -> Column:
    """Days since the first date, so that no date is negative."""
    return F.datediff(day, F.lit("0001-01-01").cast("date")).cast("long")


def _halved(x: Column, level: Column) -> Column:
    return F.call_function("shiftright", x, level)


def range_key(level: Column, index: Column) -> Column:
    """One number for the range of 2^level days that begins at index * 2^level."""
    return F.call_function("shiftleft", level.cast("long"), F.lit(_LEVEL_BITS)).bitwiseOR(index)


def level_of(key: Column) -> Column:
    return F.call_function("shiftright", key, F.lit(_LEVEL_BITS)).cast("int")


def period_ranges(first: Column, last: Column) -> Column:
    """Keys of the ranges that make up a period, both ends included; none if it ends before it begins."""
    low, high = day_number(first), day_number(last) + 1

    def at(level: Column) -> Column:
        # Of the ranges of this level inside the period, those are taken whose pair reaches beyond it.
        a, b = -_halved(-low, level), _halved(high, level)
        odd_a, odd_b = a.bitwiseAND(F.lit(1)), b.bitwiseAND(F.lit(1))
        left = F.when((odd_a == 1) & (a < b), range_key(level, a))
        right = F.when((odd_b == 1) & (a + odd_a < b), range_key(level, b - 1))
        return F.array(left, right)

    levels = F.array(*[F.lit(k) for k in range(LEVELS)])
    return F.filter(F.flatten(F.transform(levels, at)), F.isnotnull)


def day_range(day: Column, level: Column) -> Column:
    """Key of the range of a level that a day lies in."""
    return range_key(level, _halved(day_number(day), level))
