"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Row n of the table (in the given order) goes to place ``permute(n)``; shard and slot are the place modulo and divided by
the number of shards. Nothing is sorted by a random key, and both directions can be computed for a single row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlattice.llm.arrays import keys, mix
from adlattice.operators.keyed import running_position

ROUNDS = 6


@dataclass(frozen=True)
class Permutation:
    """A keyed bijection of 0 .. rows-1.

    A balanced Feistel network permutes the smallest even-bit square that holds ``rows``; places outside the range are
    walked along their cycle until they fall inside, fewer than four steps on average.
    """

    rows: int
    seed: int = 0

    @property
    def half(self) -> int:
        return max(1, (max(self.rows - 1, 1).bit_length() + 1) // 2)

    def _network(self, x: np.ndarray, backward: bool) -> np.ndarray:
        bits, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> bits, x & mask
        round_keys = keys(ROUNDS, self.seed)
        for key in round_keys[::-1] if backward else round_keys:
            if backward:
                left, right = right ^ (mix(left + key) & mask), left
            else:
                left, right = right, left ^ (mix(right + key) & mask)
        return left << bits | right

    def _walk(self, numbers: np.ndarray, backward: bool) -> np.ndarray:
        out = self._network(np.asarray(numbers, np.uint64), backward)
        while (outside := np.flatnonzero(out >= np.uint64(self.rows))).size:
            out[outside] = self._network(out[outside], backward)
        return out.astype(np.int64)

    def place(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, False)

    def number(self, places: np.ndarray) -> np.ndarray:
        """The row number at each place: the inverse of ``place``."""
        return self._walk(places, True)


def assign_shards(df: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` and ``slot``; shard counts are at most one apart, slots have no gaps.

    Rows are numbered in ``order`` (nulls first). Rows equal in all of ``order`` are numbered in any order, so give
    columns that tell unequal rows apart. Empty table: no rows. Only the columns of ``df`` that are needed further on
    should be passed, as its rows are written once. Columns of ``df`` with the three names are replaced.
    """
    df = df.drop("row_number", "shard", "slot")
    numbered = running_position(df, order, "row_number")
    permutation = Permutation(df.count(), seed)

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permutation.place(numbers.to_numpy()))

    return (
        numbered.withColumn("__place", place("row_number"))
        .withColumn("shard", F.pmod("__place", F.lit(shards)).cast("int"))
        .withColumn("slot", F.expr(f"__place div {shards}"))
        .drop("__place")
    )
