"""Exact membership in a large set of keys, row by row, without a shuffle of the rows.

A Bloom filter of the set answers "not in it" for certain. The keys that it wrongly takes
for members are found by key alone, and get a filter of their own, and so on: each filter
holds what the one before got wrong, so the last one has nothing left to get wrong, and the
first filter that turns a key down decides. Filters are built by aggregation into bitmaps
and are bounded in size, so they go to all tasks; sets beyond the bound are joined.
"""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26  # of one filter at most: 8 MB
BITS_PER_KEY = 12
HASHES = 5
LEVELS = 12
LEAST_BITS = 1 << 15
_BITMAP_BITS = 1 << 15  # of one bitmap of the aggregation


@dataclass(frozen=True)
class Filter:
    """Bits of one level, whose hashes differ from those of the other levels."""

    level: int
    bits: np.ndarray

    def positions(self, keys: list[str]) -> list[Column]:
        size = F.lit(len(self.bits) * 8).cast("long")
        return [F.pmod(F.xxhash64(F.lit(self.level * HASHES + i), *keys), size) for i in range(HASHES)]

    def passes(self, keys: list[str]) -> Column:
        bits = self.bits

        @F.pandas_udf("boolean")
        def test(*at: pd.Series) -> pd.Series:
            found = np.ones(len(at[0]), dtype=bool)
            for p in at:
                p = p.to_numpy()
                found &= (bits[p >> 3] >> (p & 7) & 1).astype(bool)
            return pd.Series(found)

        return test(*self.positions(keys))


def build(keys: DataFrame, columns: list[str], level: int, count: int) -> Filter:
    """The filter of a set of `count` keys; the driver gets its bitmaps, `BITS` bits at most."""
    wanted = max(LEAST_BITS, 1 << (count * BITS_PER_KEY - 1).bit_length() if count else 0)
    filled = Filter(level, np.zeros(wanted // 8, dtype=np.uint8))
    at = keys.select(F.explode(F.array(*filled.positions(columns))).alias("at"))
    part, bit = F.floor(F.col("at") / _BITMAP_BITS).cast("int"), F.col("at") % _BITMAP_BITS
    bitmaps = at.groupBy(part.alias("part")).agg(F.bitmap_construct_agg(bit).alias("bitmap"))
    for row in bitmaps.collect():
        start = row["part"] * _BITMAP_BITS // 8
        held = filled.bits[start : start + _BITMAP_BITS // 8]
        held[:] = np.frombuffer(row["bitmap"], dtype=np.uint8)[: len(held)]
    return filled


def fits(count: int) -> bool:
    return count * BITS_PER_KEY <= BITS


def cascade(
    keys: DataFrame, members: DataFrame, columns: list[str], stage: Callable[[DataFrame], DataFrame] = lambda f: f
) -> list[Filter] | None:
    """Filters that decide for all `keys` whether they are among `members`; None if they can't.

    Both are read at each level, with nothing but the columns; `stage` may write them to a
    table and hand that back. Keys with a null are no members.
    """
    keys = stage(keys.select(columns))
    members = stage(members.select(columns).na.drop())
    wrong, found, inside = members, [], True  # what the next filter must hold, and whether members
    passed = keys
    for level in range(LEVELS):
        count = wrong.count()
        if not count:
            return found
        if not fits(count):
            return None
        found.append(build(wrong, columns, level, count))
        passed = passed.where(found[-1].passes(columns))
        wrong = stage(passed.join(members, columns, "left_anti" if inside else "left_semi"))
        inside = not inside
    return None


def is_member(filters: list[Filter], columns: list[str]) -> Column:
    """Whether a key is a member, by the filters that were made for it."""
    verdict = F.lit(len(filters) % 2 == 1)  # of a key that passes them all
    for n, own in reversed(list(enumerate(filters))):
        verdict = F.when(own.passes(columns), verdict).otherwise(F.lit(n % 2 == 1))
    return verdict


def without(rows: DataFrame, members: DataFrame, columns: list[str], stage: Callable[[DataFrame], DataFrame] = lambda f: f) -> DataFrame:
    """Rows whose key is not among `members`: in place by a cascade, or by a join beyond its bound."""
    filters = cascade(rows, members, columns, stage)
    if filters is None:
        return rows.join(members.select(columns), columns, "left_anti")
    return rows.where(~is_member(filters, columns)) if filters else rows
