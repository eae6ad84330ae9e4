"""Filter interaction audit: what each of several filters removes, alone, in every order and by its Shapley value.

Each document becomes a bit mask of the filters that it fails, and Spark counts the masks by part of the
corpus. A part is then a game: the worth of a coalition of filters is the number of documents that it
removes. Its Hart-Mas-Colell potential comes by recursion over the coalitions,

    P(S) = (worth(S) + sum of P(S without i) over i in S) / |S|,      P({}) = 0,

the Shapley value of a filter is P(all) - P(all without it), and each step of an order of filters is the
difference of two coalitions. Potentials are held times |S|!, so that all numbers are whole.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import UPPER

FILTERS = "ABCDE"
_CONTINUATION = bytes(range(0x80, 0xC0))  # UTF-8 bytes that start no code point


def failed_bits(text: bytes | None, min_words: int = 100, min_distinct: int = 80, max_upper: int = 10, symbols: str = "#$%&*|") -> int:
    """Bits of the filters A (too few words), B (percentage of distinct words too low), C (percentage of A-Z
    too high) and D (holds a symbol) that a text fails; a null text is an empty one."""
    text = bytes(text or b"")
    words = text.split()  # [^\x20\x09-\x0D]+
    upper = len(text) - len(text.translate(None, UPPER.encode()))
    points = len(text.translate(None, _CONTINUATION))
    return ((len(words) < min_words) + 2 * (100 * len(set(words)) < min_distinct * len(words)) + 4 * (100 * upper > max_upper * points)
            + 8 * (len(text.translate(None, symbols.encode())) < len(text)))


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", **limits) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of a part fail exactly the filters of the mask; bit 4
    (E) is a text that also stands under a smaller id, anywhere in the table.

    Only an id, a 128-bit digest of the text and the mask leave the scan. Equal texts are counted by
    (digest, part, mask, labels) before their smallest id is sought, so a text with very many copies is a few rows.
    """
    @F.pandas_udf("int")
    def bits(texts: pd.Series) -> pd.Series:
        return pd.Series([failed_bits(t, **limits) for t in texts], dtype="int32")

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("digest"), bits(text.cast("binary")).alias("mask"))
    marked = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                                                             F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    keys = ["digest", "part", "mask", "good", "toxic"]
    counted = (rows.join(marked, "id", "left").fillna(False, ["good", "toxic"]).groupBy("id", *keys).agg(F.count(F.lit(1)).alias("n"))
               .groupBy(*keys).agg(F.sum("n").alias("n"), F.min("id").alias("first"), F.min_by("n", "id").alias("n_first"),
                                   F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("n_null")))
    least = F.min("first").over(Window.partitionBy("digest"))
    own = F.col("n_null") + F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    both = F.array(F.struct(F.col("mask").alias("mask"), own.alias("n")),
                   F.struct(F.col("mask").bitwiseOR(16).alias("mask"), (F.col("n") - own).alias("n")))
    return (counted.withColumn("least", least).select("part", "good", "toxic", F.explode(both).alias("x"))
            .groupBy("part", F.col("x.mask").alias("mask"), "good", "toxic").agg(F.sum("x.n").alias("n")))


def worths(masks: np.ndarray, n: np.ndarray, filters: int) -> np.ndarray:
    """How many documents each coalition of filters removes: those whose mask meets it."""
    coalitions = np.arange(1 << filters)
    return ((coalitions[:, None] & masks[None]) != 0) @ n


def potentials(worth: np.ndarray, filters: int) -> np.ndarray:
    """|S|! times the Hart-Mas-Colell potential of every coalition, by recursion over its members; whole numbers."""
    scaled = np.zeros(1 << filters, object)
    for s in range(1, 1 << filters):
        scaled[s] = factorial(s.bit_count() - 1) * int(worth[s]) + sum(scaled[s ^ (1 << i)] for i in range(filters) if s >> i & 1)
    return scaled


def order_sums(worth: np.ndarray, filters: int) -> list[int]:
    """What each filter removes, summed over all orders: the number of orders times its Shapley value."""
    p, whole = potentials(worth, filters), (1 << filters) - 1
    return [int(p[whole] - filters * p[whole ^ (1 << i)]) for i in range(filters)]


STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def interactions(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from (part, mask, good, toxic, n) (see ``failures``).

    A part has at most 4 * 2^filters cells, whatever its size, so a part is one small group.
    """
    names = list(filters)
    orders = [("".join(o), [names.index(x) for x in o]) for o in permutations(names)]

    def play(part: pd.DataFrame) -> pd.DataFrame:
        k = len(names)
        n, mask = part["n"].to_numpy(np.int64), part["mask"].to_numpy(np.int64)
        all_, good, toxic = (worths(mask, n * flag, k) for flag in (1, part["good"].to_numpy(bool), part["toxic"].to_numpy(bool)))
        total, whole, shapley = int(n.sum()), (1 << k) - 1, order_sums(all_, k)
        rows = []
        for name, order in orders:
            before = 0
            for step, i in enumerate(order, 1):
                after = before | 1 << i
                removed = all_[after] - all_[before]
                rows.append((part["part"].iloc[0], name, step, total - all_[after], removed, all_[1 << i] - removed,
                             all_[whole] - all_[whole ^ (1 << i)], good[after] - good[before], toxic[after] - toxic[before], shapley[i]))
                before = after
        return pd.DataFrame(rows, columns=[c.split()[0] for c in STEPS.split(", ")])

    return cells.groupBy("part").applyInPandas(play, STEPS)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", **limits) -> DataFrame:
    """The audit of the filters A to E (see ``failed_bits`` and ``failures``) over all documents, by part.

    Defined cases: a null text is empty, and so equal to an empty one; a null part is the part ``""``. A
    document with a null id fails no E and makes no other fail it; rows of equal text and equal id neither. A document is
    good (toxic) if any row of ``labels`` under its id says 1; labels of no document and null ids in ``labels`` count
    nowhere. Repeated rows count each; no documents give no rows; other columns are not read.
    """
    return interactions(failures(docs, labels, id_col, text_col, part_col, **limits))
