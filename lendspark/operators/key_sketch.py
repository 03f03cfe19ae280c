"""Which keys hold very many rows, from one small sketch per table.

A sketch counts a table's rows per hash bucket of a key. It is of fixed size, partial
sketches of tasks add up, and several tables are sketched in one pass over their key columns.
A bucket bounds the rows of each of its keys from above; a heavy key makes its bucket stand
out from the others.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

BUCKETS = 1 << 14
"""Buckets of a sketch; one more counts the rows without a key."""
DEVIATIONS = 8.0
"""Deviations above the median from which a bucket stands out."""


def key_bucket(df: DataFrame, key: str) -> Column:
    """Bucket of a row's key; equal whole numbers of any width share theirs."""
    value = F.col(key)
    if isinstance(df.schema[key].dataType, IntegralType):
        value = value.cast("bigint")
    hashed = F.pmod(F.xxhash64(value), F.lit(BUCKETS).cast("bigint"))
    return F.when(F.col(key).isNull(), BUCKETS).otherwise(hashed).cast("int")


@dataclass(frozen=True)
class KeySketch:
    """Per bucket the most rows that a key may hold, and how many a heavy key there holds, or 0."""

    most: np.ndarray
    heavy: np.ndarray

    @staticmethod
    def of_counts(counts: np.ndarray) -> KeySketch:
        keyed = counts[:BUCKETS].astype(np.float64)
        middle = float(np.median(keyed))
        spread = max(1.4826 * float(np.median(np.abs(keyed - middle))), middle**0.5)
        excess = counts - middle
        heavy = np.where(excess > DEVIATIONS * spread, excess, 0.0)
        # Rows without a key are one group, however the others are spread.
        heavy[BUCKETS] = counts[BUCKETS]
        return KeySketch(counts.astype(np.float64), heavy)

    @staticmethod
    def of_unique() -> KeySketch:
        """Sketch of a table known to hold every key once."""
        return KeySketch(np.ones(BUCKETS + 1), np.zeros(BUCKETS + 1))

    def joined(self, other: KeySketch) -> KeySketch:
        """Estimate for the left join of two tables on this key. Rows without a key meet none."""
        most = self.most * np.maximum(1.0, other.most)
        heavy = np.where(
            (self.heavy > 0) | (other.heavy > 0), np.maximum(1.0, self.heavy) * np.maximum(1.0, other.heavy), 0.0
        )
        most[BUCKETS], heavy[BUCKETS] = self.most[BUCKETS], self.heavy[BUCKETS]
        return KeySketch(most, heavy)

    def times(self, factor: float) -> KeySketch:
        """Estimate after a join on another key that repeats rows up to ``factor`` times."""
        if factor <= 1:
            return self
        return KeySketch(self.most * factor, np.maximum(1.0, self.heavy) * factor)


def sketches(tables: dict[str, tuple[DataFrame, str]]) -> dict[str, KeySketch]:
    """Sketches of several (table, key) in one job that reads nothing but the keys.

    Every task sends at most one row per table and bucket; the sums, a few hundred
    kilobytes a table, are all that reaches the driver.
    """
    if not tables:
        return {}
    frames = [
        df.select(F.lit(name).alias("name"), key_bucket(df, key).alias("bucket"))
        for name, (df, key) in tables.items()
    ]
    every = reduce(DataFrame.unionAll, frames).groupBy("name", "bucket").agg(F.count(F.lit(1)).alias("n"))
    found = {name: np.zeros(BUCKETS + 1) for name in tables}
    rows = every.toArrow()
    names = rows["name"].to_numpy()
    buckets, counts = rows["bucket"].to_numpy(), rows["n"].to_numpy()
    for name, sums in found.items():
        mine = names == name
        sums[buckets[mine]] = counts[mine]
    return {name: KeySketch.of_counts(counts) for name, counts in found.items()}


def crowded_buckets(left: KeySketch, right: KeySketch, pairs: int, null_safe: bool = False) -> list[int]:
    """Buckets in which some key may make more than ``pairs`` pairs of rows.

    A key counts if it is heavy on one side and, with the most the other side may hold,
    exceeds the limit. Keys heavy on neither side lie within the noise of both sketches.
    """
    l_most, r_most = np.maximum(1.0, left.most), np.maximum(1.0, right.most)
    if not null_safe:
        l_most[BUCKETS] = r_most[BUCKETS] = 1.0
    crowded = (left.heavy * r_most > pairs) | (right.heavy * l_most > pairs)
    return np.flatnonzero(crowded).tolist()
