"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Row number r goes to place p = permute(r) in 0..N-1; its shard is p mod S and its slot p div S. So
shard sizes differ by one row at most, the shuffle depends on (N, seed) alone, any row's place can be
computed without a table, and ``locate`` goes back from (shard, slot) to the row number.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import carried, row_number, text_or_empty, unpacked

ROUNDS = 8


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiplications wrap)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Feistel:
    """A keyed permutation of 0..n-1.

    The network permutes 4^k >= n values (k bits a half); a value that falls outside 0..n-1 is put
    through again until it falls inside, which keeps it a permutation and takes under four walks on average.
    """

    def __init__(self, n: int, seed: int = 0) -> None:
        self.n = n
        self.half = np.uint64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = _mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ (_mixed(left + key) & self.mask), left
            else:
                left, right = right, left ^ (_mixed(right + key) & self.mask)
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        out = self._once(np.asarray(x, np.uint64), back)
        while (far := out >= self.n).any():
            out[far] = self._once(out[far], back)
        return out.astype(np.int64)

    def permute(self, rows: np.ndarray) -> np.ndarray:
        return self._walk(rows, False)

    def invert(self, places: np.ndarray) -> np.ndarray:
        return self._walk(places, True)


def place(row: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """(shard, slot) of a row number, without any data."""
    p = int(Feistel(n, seed).permute(np.array([row]))[0])
    return p % shards, p // shards


def locate(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The row number that stands at (shard, slot)."""
    return int(Feistel(n, seed).invert(np.array([slot * shards + shard]))[0])


def shard_rows(docs: DataFrame, shards: int = 40, seed: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``row``, ``shard`` and ``slot`` added; counts of two shards differ by one at most.

    Row numbers follow (id, hash of the text), so the result does not depend on how the input is
    partitioned. Defined cases: null ids stand first; a null text counts as empty; equal rows get
    numbers of their own; with fewer rows than shards some shards stay empty; an empty table gives an
    empty one; extra columns are carried through, and columns named row, shard or slot are replaced.
    """
    added = ["row", "shard", "slot"]
    packed = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_or_empty(text_col)).alias("_hash"),
                         F.col(text_col).alias("_text"), carried(docs, [id_col, text_col]).alias("_rest"))
    numbered, n = row_number(packed, ["_id", "_hash"], "_row")

    def places(rows: pd.Series) -> pd.Series:
        return pd.Series(Feistel(max(n, 1), seed).permute(rows.to_numpy(np.int64)))

    at = numbered.withColumn("_place", F.pandas_udf(places, "long")("_row"))
    own = {id_col: F.col("_id"), text_col: F.col("_text"), "row": F.col("_row"),
           "shard": (F.col("_place") % shards).cast("int"), "slot": F.expr(f"_place div {int(shards)}")}
    return at.select(*unpacked(at, "_rest", [c for c in docs.columns if c not in added] + added, own))
