"""Language ID with language-bitmask n-gram filters.

Character n-grams of labelled texts are counted per language by Spark. An n-gram belongs to every
language in which its rate is at least ``share`` of its highest rate; each language puts its most
frequent ones into one Bloom filter. The filters of all languages lie bit-sliced in a single table:
the slot that a hash selects holds one bit per language, so the AND of an n-gram's slots is the mask of all
languages that contain it. A text is decided by its popcount per language, less the count that the
filter's fill would give by chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import checkpointed

ORDERS = (2, 3, 4)
HASHES = 3
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_KEYS = np.arange(1, HASHES + 1, dtype=np.uint64) * _PRIME


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def grams(text: str | None) -> np.ndarray:
    """64-bit hashes of the n-grams of a text: lower-cased letters, all else one space between words."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.uint64)
    # What follows a letter is kept, as a space unless it is a letter; so is the end of the text.
    after = np.concatenate(([False], letter[:-1]))
    body = np.where(letter, points, 32)[letter | after]
    clean = np.concatenate(([32], body, [32] * int(body[-1] != 32))).astype(np.uint64)
    out = []
    for n in ORDERS:
        k = len(clean) - n + 1
        if k < 1:
            continue
        h = np.full(k, n, np.uint64)
        for i in range(n):
            h = h * _PRIME + clean[i: i + k]
        out.append(_mixed(h))
    return np.concatenate(out)


class Filters:
    """Bit-sliced Bloom filters: slot -> one bit per language, in as many 64-bit words as it takes."""

    def __init__(self, members: dict[str, np.ndarray], slots: int) -> None:
        self.languages = sorted(members)
        self.shift = np.uint64(64 - (slots - 1).bit_length())
        self.bits = np.zeros((1 << (slots - 1).bit_length(), -(-max(len(members), 1) // 64)), np.uint64)
        for i, lang in enumerate(self.languages):
            for at in self._slots(members[lang]):
                self.bits[at, i // 64] |= np.uint64(1 << (i % 64))
        # The chance that a foreign n-gram finds all its slots set.
        self.chance = np.array([self._fill(i) ** HASHES for i in range(len(self.languages))])

    def _fill(self, i: int) -> float:
        return float((self.bits[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean())

    def _slots(self, h: np.ndarray) -> list[np.ndarray]:
        return [_mixed(h + key) >> self.shift for key in _KEYS]

    def masks(self, h: np.ndarray) -> np.ndarray:
        """For each n-gram the bits of all languages that contain it (some by chance)."""
        a, *rest = self._slots(h)
        out = self.bits[a]
        for b in rest:
            out &= self.bits[b]
        return out

    def counts(self, h: np.ndarray) -> np.ndarray:
        """n-grams found per language, corrected for those found by chance."""
        m = self.masks(h)
        hits = np.array([(m[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).sum() for i in range(len(self.languages))], float)
        return np.maximum((hits - len(h) * self.chance) / np.maximum(1 - self.chance, 1e-9), 0)

    def decide(self, text: str | None) -> tuple[str, float]:
        h = grams(text)
        if not len(h) or not self.languages:
            return "und", 0.0
        c = self.counts(h)
        best = int(c.argmax())  # ties: the first language in order
        return self.languages[best], float((c[best] + 1e-3) / (c.sum() + 1e-3 * len(c)))


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", train_rows: int = 20_000,
          capacity: int = 60_000, share: float = 0.3, min_count: int = 3, slots: int = 1 << 20) -> Filters:
    """Filters from about ``train_rows`` labelled rows, chosen by a hash of id and text (all if there are fewer).

    Every language has an equal share of them, or all its rows where it has fewer, however many rows the others have.
    At most ``capacity`` n-grams per language reach the driver; the counts they are chosen by are
    sums over all chosen rows, made by Spark.
    """
    rows_of = {r["lang"]: r["n"] for r in labelled.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    some = labelled
    if sum(rows_of.values()) > train_rows:
        bounds = F.create_map(*[x for lang, b in hash_bounds(rows_of, train_rows).items() for x in (F.lit(lang), F.lit(b).cast("long"))])
        some = labelled.filter(F.shiftrightunsigned(F.xxhash64(id_col, text_col), 1) <= F.element_at(bounds, F.col(lang_col)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, rows in b.groupby("lang"):
                held: list[np.ndarray] = []
                size = 0
                for i, t in enumerate(rows["text"]):
                    held.append(grams(t))
                    size += len(held[-1])
                    if size > 4_000_000 or i == len(rows) - 1:
                        g, k = np.unique(np.concatenate(held), return_counts=True)
                        yield pd.DataFrame({"lang": lang, "g": g.view(np.int64), "n": k})
                        held, size = [], 0

    each = (some.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInPandas(run, "lang string, g long, n long")
            .groupBy("g", "lang").agg(F.sum("n").alias("n")))
    counted = checkpointed(each.filter(F.col("n") >= min_count))
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return Filters({}, slots)
    rate = F.col("n") / F.element_at(F.create_map(*[x for lang, t in totals.items() for x in (F.lit(lang), F.lit(float(t)))]), F.col("lang"))
    rated = counted.withColumn("rate", rate)
    top = rated.groupBy("g").agg(F.max("rate").alias("top"))
    fit = rated.join(top, "g").filter(F.col("rate") >= share * F.col("top"))
    # The n-grams of a bounded sample: a language's are few enough for one group.
    ranked = fit.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "g"))).filter(F.col("rank") <= capacity)
    best = ranked.select("lang", "rank", "g").toPandas().sort_values(["lang", "rank"])
    return Filters({lang: x["g"].to_numpy(np.int64).view(np.uint64) for lang, x in best.groupby("lang")}, slots)


def hash_bounds(rows_of: dict[str, int], most: int) -> dict[str, int]:
    """The largest 63-bit hash of a row to take, by language: shares of ``most`` as equal as the numbers of rows allow."""
    left, bounds = most, {}
    for i, (lang, n) in enumerate(sorted(rows_of.items(), key=lambda x: (x[1], x[0]))):
        share = min(n, left // (len(rows_of) - i))
        bounds[lang] = share * (2 ** 63 - 1) // n
        left -= share
    return bounds


def identify(docs: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``; the score is the winner's share of the corrected counts.

    Rows where ``held_out`` is true, rows without a language and rows without text are not learnt
    from. Defined cases: a text that is null or has no letter is ``und`` with score 0, so is every text
    if nothing could be learnt; null ids are not held out unless the column says so; ties go to the
    first language in order; repeated rows come out once each; an empty table gives an empty one; other
    columns are not read.
    """
    held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    rows = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    filters = train(rows.filter(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()), **how)
    sent = docs.sparkSession.sparkContext.broadcast(filters)  # slots x languages / 8 bytes: set by parameters

    def run(texts: pd.Series) -> pd.DataFrame:
        f = sent.value
        return pd.DataFrame([f.decide(t) for t in texts], columns=["lang", "score"])

    out = rows.withColumn("p", F.pandas_udf(run, "lang string, score double")("text"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
