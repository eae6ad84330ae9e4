"""Benchmark decontamination over a distributed positional inverted index.

The training tokens are stored as segments: one row holds the postings (term -> positions) of the
documents one task has read, up to ``segment_tokens`` tokens, in the shared folder; it knows nothing of the
benchmark and serves any. A benchmark window is looked up in every segment: the posting list of its
rarest term there, shifted by the term's offset, is intersected with the shifted lists of its other
terms, rarer ones first. Offsets that agree exactly are phrase matches, offsets that agree up to
``slop`` are proximity matches. Document positions are spaced out by GAP, so that no match runs over
the end of a document. The benchmark goes to the tasks in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import checkpointed

GAP = 64
#: Benchmark text that one block holds, in bytes; a larger benchmark is looked up block by block.
BLOCK_BYTES = 16_000_000

# Upper case to lower case, everything outside [0-9A-Za-z] and non-ASCII bytes to a space.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the text with A-Z lower-cased; none for null."""
    return [] if text is None else bytes(text).translate(_WORD_BYTES).split()


def _packed(x: np.ndarray) -> bytes:
    return pa.compress(x.tobytes(), codec="zstd", asbytes=True)


def _plain(x: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(x, n * 4, codec="zstd", asbytes=True), np.int32)


SEGMENT = "part int, segment int, ids array<string>, sizes array<int>, terms array<binary>, counts array<int>, n int, postings binary"


def build_index(docs: DataFrame, segment_tokens: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index as a table of segments, written to the shared folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, segment = TaskContext.get().partitionId(), 0
        known: dict[bytes, int] = {}
        ids: list[str | None] = []
        sizes: list[int] = []
        tokens: list[np.ndarray] = []

        def close() -> pd.DataFrame:
            nonlocal known, ids, sizes, tokens, segment
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
            at = _positions(np.array(sizes, np.int64))
            order = np.argsort(flat, kind="stable")
            # A term's positions rise, so differences are small; its first one is absolute.
            counts = np.bincount(flat, minlength=len(known)).astype(np.int32)
            sorted_at = at[order]
            gaps = np.diff(sorted_at, prepend=0)
            first = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else np.zeros(0, np.int64)
            gaps[first[counts > 0]] = sorted_at[first[counts > 0]]
            row = (part, segment, ids, sizes, list(known), counts.tolist(), len(flat), _packed(gaps.astype(np.int32)))
            known, ids, sizes, tokens, segment = {}, [], [], [], segment + 1
            return pd.DataFrame([row], columns=[c.split()[0] for c in SEGMENT.split(", ")])

        total = 0
        for x in batches:
            for doc_id, text in zip(x["doc_id"], x["text"]):
                found = words(text)
                new = known.setdefault
                ids.append(doc_id)
                sizes.append(len(found))
                tokens.append(np.fromiter((new(w, len(known)) for w in found), np.int32, len(found)))
                total += len(found) + GAP
                if total >= segment_tokens:
                    yield close()
                    total = 0
        if ids:
            yield close()

    read = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return checkpointed(read.mapInPandas(run, SEGMENT))


def _positions(sizes: np.ndarray) -> np.ndarray:
    """Positions of all tokens, GAP apart between documents."""
    starts = np.cumsum(sizes + GAP) - (sizes + GAP)
    n = int(sizes.sum())
    first = np.cumsum(sizes) - sizes
    return np.arange(n) + np.repeat(starts - first, sizes)


class Windows:
    """The distinct windows of a block of benchmark items: rows of term numbers, and whose they are."""

    def __init__(self, items: list[tuple[str, bytes | None]], size: int) -> None:
        self.terms: dict[bytes, int] = {}
        rows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.terms.setdefault(w, len(self.terms)) for w in words(text)]
            for i in range(max(1, len(ids) - size + 1) if ids else 0):
                rows.setdefault(tuple(ids[i: i + size]), set()).add(item)
        self.owners = [sorted(x) for x in rows.values()]
        self.length = np.array([len(x) for x in rows], np.int64)
        self.rows = np.full((len(rows), size), -1, np.int64)
        for k, x in enumerate(rows):
            self.rows[k, : len(x)] = x


class Segment:
    """One row of the index, opened: a sorted position list for each term."""

    def __init__(self, row) -> None:
        self.number = {bytes(t): i for i, t in enumerate(row.terms)}
        self.counts = np.asarray(row.counts, np.int64)
        self.ends = np.cumsum(self.counts)
        gaps = _plain(row.postings, row.n).astype(np.int64)
        total = np.cumsum(gaps)
        first = self.ends - self.counts
        before = total[first] - gaps[first] if len(gaps) else np.zeros(0, np.int64)
        self.at = total - np.repeat(before, self.counts)
        self.sizes = np.asarray(row.sizes, np.int64)
        self.starts = np.cumsum(self.sizes + GAP) - (self.sizes + GAP)

    def postings(self, term: int) -> np.ndarray:
        return self.at[self.ends[term] - self.counts[term]: self.ends[term]]

    def lookup(self, windows: Windows, slop: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(window, starts of exact matches, starts of matches within slop) where there are any."""
        number = np.array([self.number.get(t, -1) for t in windows.terms], np.int64)
        mine = np.where(windows.rows >= 0, number[windows.rows], 0)
        all_here = ((mine >= 0) | (windows.rows < 0)).all(axis=1)
        for k in np.flatnonzero(all_here).tolist():
            n = int(windows.length[k])
            terms = mine[k, :n]
            order = np.argsort(self.counts[terms], kind="stable").tolist()
            starts = self.postings(terms[order[0]]) - order[0]
            if slop and order[0]:
                starts = np.unique((starts[:, None] + np.arange(-slop, slop + 1)).ravel())
            for o in order[1:]:
                if not len(starts):
                    break
                # The first term fixes the place of a match; the others may be off by slop.
                starts = starts[self._near(terms[o], starts + o, slop if o else 0)]
            if not len(starts):
                continue
            exact = starts
            for o in order if slop else ():
                exact = exact[self._near(terms[o], exact + o, 0)]
            yield k, exact, starts

    def _near(self, term: int, want: np.ndarray, slop: int) -> np.ndarray:
        at = self.postings(term)
        i = np.searchsorted(at, want - slop)
        return (i < len(at)) & (at[np.minimum(i, len(at) - 1)] <= want + slop)


FOUND = "part int, segment int, place int, doc_id string, n_words long, spans array<struct<a:long,b:long>>, items array<string>, near_items array<string>"


def _probe(index: DataFrame, windows: Windows, slop: int) -> DataFrame:
    sent = index.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = sent.value
        for x in batches:
            for row in x.itertuples(index=False):
                s = Segment(row)
                spans: dict[int, list[tuple[int, int]]] = {}
                items: dict[int, set[str]] = {}
                near: dict[int, set[str]] = {}
                for k, exact, close in s.lookup(w, slop) if row.n else ():
                    n = int(w.length[k])
                    doc = np.searchsorted(s.starts, close, "right") - 1
                    inside = (close >= s.starts[doc]) & (close + n <= s.starts[doc] + s.sizes[doc])
                    for d in np.unique(doc[inside]).tolist():
                        near.setdefault(d, set()).update(w.owners[k])
                    doc = np.searchsorted(s.starts, exact, "right") - 1
                    for d, p in zip(doc.tolist(), exact.tolist()):
                        spans.setdefault(d, []).append((p - int(s.starts[d]), p - int(s.starts[d]) + n))
                        items.setdefault(d, set()).update(w.owners[k])
                yield pd.DataFrame({
                    "part": row.part, "segment": row.segment, "place": np.arange(len(s.sizes)), "doc_id": list(row.ids), "n_words": s.sizes,
                    "spans": [[{"a": a, "b": b} for a, b in merged(spans.get(d, []))] for d in range(len(s.sizes))],
                    "items": [sorted(items.get(d, ())) for d in range(len(s.sizes))],
                    "near_items": [sorted(near.get(d, set()) - items.get(d, set())) for d in range(len(s.sizes))]})

    return index.mapInPandas(run, FOUND)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, slop: int = 2, share: int = 20, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, near_items, spans, contaminated.

    n_hit counts the words inside any exact occurrence of a window; contaminated is n_hit > 0 and
    share * n_hit >= n_words. near_items lists items without an exact match of which a window's first
    term stands somewhere and the others within ``slop`` words of their places after it, the whole
    window inside the text; spans are [a, b) in words.

    Defined cases: null or wordless texts have no words and are never contaminated; null or wordless
    items have no windows; a null item id counts as the id "null"; items that repeat count once;
    repeated rows come out once each; empty tables give zeros or no rows; other columns are not read.
    """
    if window + slop > GAP:
        raise ValueError(f"window + slop must not exceed {GAP}")
    kind = docs.schema[id_col].dataType
    index = build_index(docs, id_col=id_col, text_col=text_col)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(item_text_col).cast("binary").alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    found = None
    for b in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()  # bounded by block_bytes
        part = _probe(index, Windows([(r["item"], r["text"]) for r in block], window), slop)
        found = part if found is None else found.unionByName(part)
    if blocks > 1:
        found = (found.groupBy("part", "segment", "place", "doc_id", "n_words")
                 .agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
                      F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items")))
    # Words in the union of the spans: each span adds what lies beyond the end of those before it.
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    n_hit = F.aggregate(F.array_sort("spans"), start, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"),
        F.greatest(acc["end"], s["b"]).alias("end")))["n"]
    out = found.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_words", n_hit.alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"), F.array_sort("items").alias("items"),
                       F.array_sort(F.array_except("near_items", "items")).alias("near_items"), "spans")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
