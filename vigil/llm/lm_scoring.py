"""LM scoring: a causal self-attention model over subword ids, trained in numpy, scored by Spark.

The model is a distribution over the words that may come next, and over the end of the text:

    P(word | context) = P(class | context) * P(word | class)

A class is a group of subword ids that start words; the end of a text is a class of its own. P(class |
context) is a softmax over causal self-attention: each word before is a position whose vector is the mean of
its subword ids' vectors, in windows of two blocks. P(word | class) is what all training rows say,

    (count(word) - discount)+ / count(class)  +  discount * words(class) / count(class) * P(spelling | class),

where the spelling goes from subword id to subword id and to the word's end. Each factor adds up to one over
its outcomes, so the probabilities of all next words and the end do: a text's score is a log-probability.

Spark gathers, over all training rows, the word counts, how often each subword id stands in a word before
each id that starts one, and from the counted words the neighbours inside words. The driver receives only sums of fixed
shape (by symbol, class and input symbol), never the word or pair tables. The attention weights are trained
by local steps on all training rows, each in one round, and averaged by Spark after each round.

A text is scored in windows of two blocks that overlap by one: a window's queries are its second block, its
keys both blocks up to the query. Each token is scored exactly once, with at least a block of context
where the text has one. Windows go through the attention in batches.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain, compress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.bpe import byte_pairs
from vigil.llm.common import checkpointed

BLOCK = 16
DIM = 16
CLASSES = 64  # of ids that start words; class 0 is the end of the text
INNER = 256  # classes of ids inside words; one more for the word's end
INPUTS = 4096  # frequent symbols for themselves, others by their class
COLUMNS = 128
SYMBOLS = 50257
END = 50256
SHARDS = 4096  # of one round at most
SHORT = 16  # ids of a word that are added up by their place in it
OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c != " " and c.isspace()]  # all there is


def words_of(text: bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased; none for null."""
    return [] if text is None else bytes(text).lower().split()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of binary texts (see ``words_of``), one after the other, and how many each text has, split by Arrow byte by byte."""
    texts = pc.fill_null(texts.cast(pa.binary()), b"")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words, n = lists.flatten().view(pa.binary()), pc.list_value_length(lists).to_numpy().astype(np.int64)
    real = pc.binary_length(words).to_numpy() > 0  # white space at an end leaves an empty word there
    if not real.all():
        n -= np.bincount(np.repeat(np.arange(len(n)), n)[~real], minlength=len(n))
        words = words.filter(pa.array(real))
    return words, n


def odd_spaced(text: str) -> bool:
    """Whether there is other white space in a text than spaces."""
    return any(c in text for c in OTHER_SPACE)


def subwords(path: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of the words, each as it stands after a space, one after the other; and how many each has.

    The words are encoded as one text: no id runs over a space, and only a word's first id starts with
    one. Words with other white space inside could shift that, so they are encoded alone.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = byte_pairs(path)
    text = b" ".join(words).decode("utf-8", "replace")
    if not odd_spaced(text):
        flat = pairs.array(" " + text, False)
        return flat, np.diff(np.flatnonzero(pairs.after_space[flat]), append=len(flat))
    texts = [w.decode("utf-8", "replace") for w in words]
    odd = np.array([odd_spaced(t) for t in texts])
    flat, size = subwords(path, [w for w, o in zip(words, odd) if not o])
    parts = iter(np.split(flat, np.cumsum(size)[:-1]))
    ids = [pairs.array(" " + t, False) if o else next(parts) for t, o in zip(texts, odd)]
    return np.concatenate(ids), np.array([len(x) for x in ids])


def digest(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)


@dataclass
class Batch:
    """Some texts: their distinct words as subword ids, word 0 being the end, and their tokens as numbers of these."""

    words: list[bytes] | pa.Scalar  # or joined by spaces
    flat: np.ndarray  # subword ids of the words, one after the other
    size: np.ndarray  # ids of each word
    every: np.ndarray  # all tokens: the words of each text, and its end
    n: np.ndarray  # tokens of each text

    @property
    def start(self) -> np.ndarray:
        return np.cumsum(self.size) - self.size

    @property
    def first(self) -> np.ndarray:
        """First id of each word."""
        return self.flat[self.start]

    def before(self) -> np.ndarray:
        """The word before each token; a text's end stands before its first."""
        out = np.zeros_like(self.every)
        out[1:] = self.every[:-1]
        return out

    def some(self, texts: np.ndarray) -> Batch:
        """The texts that ``texts`` marks."""
        return Batch(self.words, self.flat, self.size, self.every[np.repeat(texts, self.n)], self.n[texts])


def batch_of(path: str, texts: list[list[bytes]]) -> Batch:
    return numbered(path, pa.array(list(chain.from_iterable(texts)), pa.binary()), np.fromiter(map(len, texts), np.int64, len(texts)))


def numbered(path: str, words: pa.Array, n: np.ndarray) -> Batch:
    """The batch of texts of ``n`` words each, which stand one after the other in ``words``."""
    found = words.dictionary_encode()  # in the order of coming; the end comes first
    n = n + 1
    every = np.zeros(int(n.sum()), np.int32)
    inside = np.ones(len(every), bool)
    inside[np.cumsum(n) - 1] = False
    every[inside] = found.indices.to_numpy() + 1
    distinct = found.dictionary.to_pylist()
    flat, size = subwords(path, distinct)
    return Batch([b"", *distinct], np.append(END, flat), np.append(1, size), every, n)


ENCODED = "ids array<string>, held array<boolean>, words binary, flat binary, every binary, n array<long>"


def encoded(rows: DataFrame, path: str, most: int = 4_000_000) -> DataFrame:
    """Rows (doc_id as a string, held_out, text as binary) as batches of about ``most`` bytes of text: tokenized once, for all that follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, held = b["doc_id"], b["held_out"]
            size = np.cumsum(pc.fill_null(pc.binary_length(b["text"]), 0).to_numpy())
            cuts = np.append(np.flatnonzero(np.diff(size // most, append=-1)), b.num_rows - 1)
            first = 0
            for last in np.unique(cuts) + 1:
                x = numbered(path, *split_words(b["text"].slice(first, last - first)))
                lists = pa.array([0, last - first], pa.int32())
                width = 3 if len(x.words) < 1 << 24 else 4  # bytes of a word's number
                every = np.ascontiguousarray(x.every).view(np.uint8).reshape(-1, 4)[:, :width].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(lists, ids.slice(first, last - first)), pa.ListArray.from_arrays(lists, held.slice(first, last - first)),
                     pa.array([b" ".join(x.words)], pa.binary()), pa.array([x.flat.astype(np.uint16).tobytes()], pa.binary()), pa.array([every], pa.binary()),
                     pa.ListArray.from_arrays(lists, pa.array(x.n))], names=[c.split()[0] for c in ENCODED.split(", ")])
                first = last

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, ENCODED)


def decoded(batches: Iterator[pa.RecordBatch], path: str, mine: Callable[[int], bool] = lambda i: True) -> Iterator[tuple[pa.Array, pa.Array, Batch]]:
    """(ids, held, batch) of each encoded row whose number in the task ``mine`` accepts; ``words`` are left to be split."""
    at = -1
    begins = byte_pairs(path).after_space
    for b in batches:
        for i in range(b.num_rows):
            at += 1
            if not mine(at):
                continue
            flat = np.frombuffer(b["flat"][i].as_buffer(), np.uint16).astype(np.int64)
            n = b["n"][i].values.to_numpy()
            raw = np.frombuffer(b["every"][i].as_buffer(), np.uint8).reshape(int(n.sum()), -1)
            every = np.zeros((len(raw), 4), np.uint8)
            every[:, : raw.shape[1]] = raw
            size = np.diff(np.flatnonzero(begins[flat] | (flat == END)), append=len(flat))
            yield b["ids"][i].values, b["held"][i].values, Batch(b["words"][i], flat, size, every.view(np.int32).ravel(), n)


def ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order, and the place of each id among them."""
    there = np.zeros(SYMBOLS, bool)
    there[ids] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[ids]


GATHERED = "word binary, a int, b int, n long"


def gathered(batches: DataFrame, path: str) -> DataFrame:
    """(word, a, b, n) over all training texts of ``encoded`` batches: counts of words (``""`` is the end; a, b null), and how
    often the subword id ``a`` stands in the word, or start, before the id ``b`` that starts a word, or END (word null)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pairs = Counter(), []

        def out() -> Iterator[pa.RecordBatch]:
            n = len(held)
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()),
                                              pa.array(list(held.values()), pa.int64())], names=["word", "a", "b", "n"])
            key, at = np.unique(np.concatenate([k for k, _ in pairs]), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate([m for _, m in pairs])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(key), pa.binary()), pa.array((key // SYMBOLS).astype(np.int32)),
                                              pa.array((key % SYMBOLS).astype(np.int32)), pa.array(total)], names=["word", "a", "b", "n"])
            held.clear()
            pairs.clear()

        for _, held_out, x in decoded(rows, path):
            x = x.some(~held_out.to_numpy(zero_copy_only=False))
            if not len(x.n):
                continue
            n = np.bincount(x.every, minlength=len(x.size)).tolist()
            held.update({w: c for w, c in zip(x.words.as_py().split(b" "), n) if c})
            ids, code = ranked(x.flat)
            firsts, first = ranked(x.first)
            before = x.before()
            size = x.size[before]
            ends = np.cumsum(size)
            left = code[np.arange(ends[-1]) + np.repeat(x.start[before] - ends + size, size)]
            key = left * len(firsts) + np.repeat(first[x.every], size)
            if len(ids) * len(firsts) < 8_000_000:
                m = np.bincount(key, minlength=len(ids) * len(firsts))
                key = np.flatnonzero(m)
                m = m[key]
            else:
                key, m = np.unique(key, return_counts=True)
            pairs.append((ids[key // len(firsts)] * SYMBOLS + firsts[key % len(firsts)], m))
            if len(held) > 500_000 or len(pairs) > 20:
                yield from out()
        if pairs:
            yield from out()

    return batches.mapInArrow(run, GATHERED).groupBy("word", "a", "b").agg(F.sum("n").alias("n"))


TYPES = "kind int, a int, b int, n long"


def spelled(counts: DataFrame, path: str) -> DataFrame:
    """(kind, a, b, n) over the counted words, each once: kind 0, id ``b`` follows ``a`` inside words, SYMBOLS is a word's end; kind 1,
    words, 2, their counts, 3 and 4, words counted once and twice, by first id ``a``. The end of the text is a word of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, n = b["word"].to_pylist(), b["n"].to_numpy()
            if not words:
                continue
            flat, size = subwords(path, [w for w in words if w])
            n = np.append(n[[bool(w) for w in words]], n[[not w for w in words]])
            ends = len(n) - len(size)
            flat, size = np.append(flat, np.full(ends, END)), np.append(size, np.ones(ends, np.int64))
            start = np.cumsum(size) - size
            right = np.append(flat[1:], SYMBOLS)
            right[start + size - 1] = SYMBOLS
            key, m = np.unique(flat * (SYMBOLS + 1) + right, return_counts=True)
            out = [(np.zeros(len(key)), key // (SYMBOLS + 1), key % (SYMBOLS + 1), m)]
            first = flat[start]
            for kind, weight in ((1, np.ones(len(n))), (2, n), (3, n == 1), (4, n == 2)):
                total = np.bincount(first, weights=weight, minlength=SYMBOLS)
                some = np.flatnonzero(total)
                out.append((np.full(len(some), kind), some, np.zeros(len(some)), total[some]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(t)) for x, t in zip(zip(*out), (np.int32, np.int32, np.int32, np.int64))],
                                             names=["kind", "a", "b", "n"])

    return counts.select("word", "n").mapInArrow(run, TYPES).groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))


def reduced(pairs: DataFrame, left: np.ndarray, right: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Sums of n by (left[a], right[b]) as a matrix of ``shape``, which bounds what is collected; -1 is left out."""
    to = lambda which, x: F.pandas_udf(lambda s: pd.Series(x[s.to_numpy()]), "int")(which)
    rows = (pairs.select(to(F.col("a"), left.astype(np.int32)).alias("i"), to(F.col("b"), right.astype(np.int32)).alias("j"), "n")
            .filter("i >= 0 AND j >= 0").groupBy("i", "j").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(shape)
    out[rows["i"].to_numpy(), rows["j"].to_numpy()] = rows["n"].to_numpy()
    return out


# --- the model ---

@dataclass
class Model:
    """Everything that scoring needs, of a size that does not grow with the corpus: about 10 MB."""

    path: str
    classes: np.ndarray  # id that starts words, or END -> class; -1 for others
    inputs: np.ndarray  # the same -> row of bigram
    bigram: np.ndarray  # -> class logits after a word that starts so
    features: np.ndarray  # id -> DIM
    first: np.ndarray  # log P(id | its class)
    left: np.ndarray  # id -> row of follow
    inner: np.ndarray  # id inside words -> inner class, SYMBOLS -> INNER; -1 for others
    follow: np.ndarray  # log P(inner class | row)
    within: np.ndarray  # log P(id | its inner class); 0 for the word's end
    tokens: np.ndarray  # counted words by class
    words: np.ndarray  # distinct ones
    discount: float
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def spelling(self, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
        """log P(spelling | class) of words: their first ids in their classes, what follows, and their ends."""
        if not len(size):
            return np.zeros(0)
        start = np.cumsum(size) - size
        right = np.append(flat[1:], SYMBOLS)
        right[start + size - 1] = SYMBOLS
        step = self.follow[self.left[flat], self.inner[right]] + self.within[right]
        return np.where(flat[start] == END, 0.0, self.first[flat[start]] + np.add.reduceat(step, start))

    def unseen(self, classes: np.ndarray) -> np.ndarray:
        """log of the share of each class that goes by spelling."""
        n = self.tokens[classes]
        return np.where(n > 0, np.log(self.discount * np.maximum(self.words[classes], 1e-300) / np.maximum(n, 1)), 0.0)

    def in_class(self, spelling: np.ndarray, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log P(word | class) from log P(spelling | class) and the word's count; the end is certain in its class."""
        seen = counts > 0
        by_count = np.log(np.where(seen, counts - self.discount, 1.0)) - np.log(np.maximum(self.tokens[classes], 1))
        by_spelling = self.unseen(classes) + spelling
        return np.where(classes == 0, 0.0, np.where(seen, np.logaddexp(by_count, by_spelling), by_spelling))


def start_weights(seed: int = 11) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    small = lambda *s: (r.standard_normal(s) / np.sqrt(DIM)).astype(np.float32)
    return {"q": small(DIM, DIM), "k": small(DIM, DIM), "v": small(DIM, DIM), "u": np.zeros((DIM, CLASSES), np.float32),
            "r": np.zeros(2 * BLOCK, np.float32), "b": np.zeros(CLASSES, np.float32)}


def _grouped(x: np.ndarray, weight: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """Weighted k-means of rows: the group of each."""
    if len(x) <= k:
        return np.arange(len(x))
    centers = x[np.random.default_rng(seed).choice(len(x), k, replace=False, p=weight / weight.sum())]
    near = np.zeros(len(x), np.int64)
    for _ in range(15):
        near = ((centers ** 2).sum(1)[None] - 2 * x @ centers.T).argmin(1)
        mass = np.bincount(near, weights=weight, minlength=k)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x * weight[:, None])
        centers = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-9)[:, None], centers).astype(x.dtype)
    return near


def _columns(total: np.ndarray) -> np.ndarray:
    """The most frequent symbols have columns of their own, the others the last one."""
    out = np.full(len(total), COLUMNS - 1)
    out[np.argsort(-total, kind="stable")[: COLUMNS - 1]] = np.arange(COLUMNS - 1)
    return out


def _rates(x: np.ndarray) -> np.ndarray:
    return np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def _inputs(total: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Row of each symbol: the first rows are the groups', the others the most frequent symbols' own."""
    out = group.copy()
    frequent = np.argsort(-total, kind="stable")[: INPUTS - groups]
    frequent = frequent[total[frequent] > 0]
    out[frequent] = groups + np.arange(len(frequent))
    return out


def build(beside: DataFrame, types: DataFrame, path: str) -> Model:
    """The model with its weights at their start, from ``gathered`` pairs and ``spelled`` words."""
    symbols, starts = np.arange(SYMBOLS), np.zeros(SYMBOLS, bool)
    known = byte_pairs(path).after_space[:SYMBOLS]
    starts[: len(known)] = known
    starts[END] = True
    only, every = np.zeros(SYMBOLS + 1, np.int64), np.append(symbols, SYMBOLS)
    inside = types.filter("kind = 0")
    of_first = np.stack([reduced(types.filter(F.col("kind") == k), symbols, only, (SYMBOLS, 1))[:, 0] for k in (1, 2, 3, 4)])
    # Classes of starting ids, by what words start with before and after theirs.
    before, after = reduced(beside, symbols, only, (SYMBOLS, 1))[:, 0], reduced(beside, only, symbols, (1, SYMBOLS))[0]
    from_start = np.where(starts, symbols, -1)
    column = _columns(after)
    follows = reduced(beside, symbols, column, (SYMBOLS, COLUMNS))
    precedes = reduced(beside, np.where(starts, _columns(np.where(starts, before, 0)), -1), from_start, (COLUMNS, SYMBOLS)).T
    seen = np.flatnonzero(starts & (after > 0) & (symbols != END))
    classes = np.where(starts, CLASSES - 1, -1)
    classes[END] = 0
    profile = np.concatenate((_rates(follows), _rates(precedes)), axis=1)
    if len(seen):
        classes[seen] = 1 + _grouped(profile[seen], np.sqrt(after[seen]), CLASSES - 2)
    by_first = lambda x: np.bincount(classes[starts], weights=x[starts], minlength=CLASSES)
    smoothed = np.where(starts, of_first[0] + 0.05, 0)
    with np.errstate(divide="ignore"):
        first = np.log(smoothed / by_first(smoothed)[classes])
    # Class logits after each starting id, and after each class for the rare ones.
    inputs = _inputs(np.where(starts, after, 0), np.maximum(classes, 0), CLASSES)
    counts = np.zeros((INPUTS, CLASSES))
    for rows in (inputs, classes):
        counts += reduced(beside, np.where(starts, rows, -1), np.where(starts, classes, -1), (INPUTS, CLASSES))
    there = np.bincount(classes[starts], minlength=CLASSES) > 0  # classes without an id are never next
    prior = (np.bincount(classes[starts], weights=after[starts], minlength=CLASSES) + 0.01) * there
    counts += (2.0 * prior / prior.sum() + 0.001) * there
    bigram = np.where(there, np.log(np.maximum(counts, 1e-9) / counts.sum(axis=1, keepdims=True)), -1e4).astype(np.float32)
    # Vectors of all ids, by what words start with after theirs.
    weight = follows.sum(axis=1)
    f = _rates(follows).astype(float)
    f[weight == 0] = 0
    mean = (f * weight[:, None]).sum(axis=0) / max(weight.sum(), 1)
    f -= mean
    f *= (weight / (weight + 20))[:, None]  # rare ones near the mean
    _, s, vt = np.linalg.svd((f * np.sqrt(weight / max(weight.sum(), 1))[:, None]).T @ (f * np.sqrt(weight / max(weight.sum(), 1))[:, None]))
    features = np.clip(f @ vt[:DIM].T / np.maximum(np.sqrt(s[:DIM]), 1e-3), -4, 4).astype(np.float32)
    # Inside words: classes of inner ids, and what follows each id.
    used = reduced(inside, only, every, (1, SYMBOLS + 1))[0]
    as_left = reduced(inside, symbols, only, (SYMBOLS, 1))[:, 0]
    column = np.append(_columns(np.where(starts, 0, used[:SYMBOLS])), -1)
    ends = reduced(inside, symbols, np.append(np.full(SYMBOLS, -1), 0), (SYMBOLS, 1))
    shape = np.concatenate((_rates(np.concatenate((reduced(inside, symbols, column, (SYMBOLS, COLUMNS)), ends), axis=1)),
                            _rates(reduced(inside, _columns(as_left), every, (COLUMNS, SYMBOLS + 1)).T[:SYMBOLS])), axis=1)
    inner = np.where(starts, -1, INNER - 1)
    there = np.flatnonzero(~starts & (used[:SYMBOLS] > 0))
    if len(there):
        inner[there] = _grouped(shape[there], np.sqrt(used[there]), INNER - 1)
    smoothed = np.where(starts, 0, used[:SYMBOLS] + 0.05)
    with np.errstate(divide="ignore"):
        within = np.log(smoothed / np.bincount(inner[~starts], weights=smoothed[~starts], minlength=INNER)[inner])
    inner, within = np.append(inner, INNER), np.append(within, 0.0)
    group = np.where(starts, CLASSES + INNER - 1 - np.maximum(classes, 0), np.maximum(inner[:SYMBOLS], 0))
    left = _inputs(as_left, group, CLASSES + INNER)
    counts = np.zeros((INPUTS, INNER + 1))
    for rows in (left, group):
        counts += reduced(inside, rows, inner, (INPUTS, INNER + 1))
    total = np.bincount(inner[inner >= 0], weights=used[inner >= 0] + 0.05, minlength=INNER + 1)  # nothing for classes without an id
    counts += 8.0 * total / total.sum()
    once, twice = of_first[2].sum(), of_first[3].sum()
    with np.errstate(divide="ignore"):
        follow = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    return Model(path, classes, inputs, bigram, features, first, left, inner, follow, within,
                 by_first(of_first[1]), by_first(of_first[0]), float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.9)), start_weights())


# --- attention ---

_DISTANCE = np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)[None, :]  # from query to key; negative lies ahead
_NEAR = np.clip(_DISTANCE, 0, 2 * BLOCK - 1)
_SEEN = (_DISTANCE >= 0).astype(np.float32)


def blocks(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequences of n positions as blocks of BLOCK places, each sequence after one empty block: (place of each position,
    which blocks are the empty ones, places)."""
    count = -(-n // BLOCK) + 1
    first = np.cumsum(count) - count
    place = np.arange(n.sum()) + np.repeat((first + 1) * BLOCK - (np.cumsum(n) - n), n)
    empty = np.zeros(int(count.sum()), bool)
    empty[first] = True
    return place, empty, int(count.sum()) * BLOCK


def word_vectors(model: Model, x: Batch) -> np.ndarray:
    """The mean vector of each word's subword ids; a last row of zeros stands for no word."""
    out = np.zeros((len(x.size) + 1, DIM), np.float32)
    order = np.argsort(-x.size, kind="stable")  # longest first: those that have a next id are always the first few
    start, size = x.start[order], x.size[order]
    sums = np.take(model.features, x.flat[start], axis=0)
    at_least = lambda k: int(np.searchsorted(-size, -k, side="right"))
    long = at_least(SHORT + 1)
    for k in range(1, SHORT):
        more = at_least(k + 1)
        sums[long:more] += np.take(model.features, x.flat[start[long:more] + k], axis=0)
    if long:
        ends = np.cumsum(size[:long])
        first = ends - size[:long]
        ids = x.flat[np.arange(ends[-1]) + np.repeat(start[:long] - first, size[:long])]
        sums[:long] = np.add.reduceat(model.features[ids], first, axis=0)
    out[order] = sums / size[:, None].astype(np.float32)
    return out


def class_scores(model: Model, vectors: np.ndarray, inputs: np.ndarray, before: np.ndarray, target: np.ndarray, n: np.ndarray, batch: int = 256) -> np.ndarray:
    """log P(class of each token | the words before it in its text), natural logarithm.

    ``before`` numbers the word before each token, ``vectors`` (with a last row for none) and ``inputs`` are by word,
    ``target`` is the class of each token, for texts of ``n`` tokens. Memory beside these goes by ``batch`` windows.
    """
    w = model.weights
    place, empty, places = blocks(n)
    words, goal = np.full(places, -1, np.int32), np.zeros(places, np.int32)
    words[place], goal[place] = before, target
    kvw = np.concatenate((w["k"], w["v"]), axis=1)
    qw = w["q"] * np.float32(DIM ** -0.5)
    prior = np.exp(np.minimum(w["r"][_NEAR], 30)) * _SEEN
    first, ones = model.bigram + w["b"], np.ones(CLASSES, np.float32)
    out = np.zeros(places)
    for at in range(0, places // BLOCK - 1, batch):
        m = min(batch, places // BLOCK - 1 - at)
        some = words[at * BLOCK: (at + m + 1) * BLOCK]
        e = np.take(vectors, some, axis=0)
        kv = np.ones((len(some), 2 * DIM + 1), np.float32)  # the last column adds up the weights
        np.matmul(e, kvw, out=kv[:, : 2 * DIM])
        step, item = kv.strides
        kv = np.lib.stride_tricks.as_strided(kv, (m, 2 * BLOCK, 2 * DIM + 1), (BLOCK * step, step, item), writeable=False)
        a = (e[BLOCK:] @ qw).reshape(m, BLOCK, DIM) @ kv[..., :DIM].transpose(0, 2, 1)
        np.minimum(a, np.float32(40), out=a)
        np.exp(a, out=a)
        a *= prior
        a[empty[at: at + m], :, :BLOCK] = 0
        h = a @ kv[..., DIM:]
        h = (h[..., :DIM] / h[..., DIM:]).reshape(-1, DIM)
        z = h @ w["u"]
        z += np.take(first, inputs[some[BLOCK:]], axis=0)
        np.minimum(z, np.float32(60), out=z)
        here = slice((at + 1) * BLOCK, (at + 1 + m) * BLOCK)
        gold = z[np.arange(len(z)), goal[here]]
        np.exp(z, out=z)
        out[here] = gold - np.log(z @ ones + np.float32(1e-30))
    return out[place]


def gradients(model: Model, w: dict[str, np.ndarray], e: np.ndarray, inputs: np.ndarray, c: np.ndarray, alone: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss of a batch of windows and its gradient by weight.

    ``e`` (n, 2 BLOCK, DIM) are word vectors, ``inputs`` and ``c`` (n, BLOCK) the input rows and target classes of the
    second block, c = -1 where there is no position; ``alone`` says whose first block is empty.
    """
    scale = e.dtype.type(DIM ** -0.5)
    flat, eq = e.reshape(-1, DIM), e[:, BLOCK:].reshape(-1, DIM)
    q = (eq @ (w["q"] * scale)).reshape(-1, BLOCK, DIM)
    kv = (flat @ np.concatenate((w["k"], w["v"]), axis=1)).reshape(-1, 2 * BLOCK, 2 * DIM)
    k, v = kv[..., :DIM], kv[..., DIM:]
    a = q @ k.transpose(0, 2, 1)
    a += w["r"][_NEAR]
    np.minimum(a, 40, out=a)
    np.exp(a, out=a)
    a *= _SEEN
    a[alone, :, :BLOCK] = 0
    a /= a.reshape(-1, 2 * BLOCK).dot(np.ones(2 * BLOCK, e.dtype)).reshape(-1, BLOCK, 1)
    h = (a @ v).reshape(-1, DIM)
    goal = c.ravel()
    real = (goal >= 0).astype(e.dtype)
    n = max(np.count_nonzero(real), 1)
    p = np.take(model.bigram, inputs.ravel(), axis=0)  # of the rows asked for only: the table is far larger than a batch
    p = h @ w["u"] + p
    p += w["b"]
    np.minimum(p, 60, out=p)
    np.exp(p, out=p)
    total = p.dot(np.ones(CLASSES, e.dtype))
    at = (np.arange(len(p)), np.maximum(goal, 0))
    loss = float(-(np.log(p[at] / total + 1e-30) * real).sum() / n)
    real /= n
    p *= (real / total)[:, None]
    p[at] -= real
    g = {"u": h.T @ p, "b": np.ones(len(p), e.dtype) @ p}
    dh = p @ w["u"].T
    da = dh.reshape(-1, BLOCK, DIM) @ v.transpose(0, 2, 1)
    da -= (dh * h).dot(np.ones(DIM, e.dtype)).reshape(-1, BLOCK, 1)
    da *= a
    g["r"] = np.bincount(_NEAR.ravel(), weights=da.sum(axis=0).ravel() * (_DISTANCE >= 0).ravel(), minlength=2 * BLOCK).astype(e.dtype)
    g["q"] = eq.T @ (da @ k).reshape(-1, DIM) * scale
    dkv = np.concatenate((da.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dh.reshape(-1, BLOCK, DIM)), axis=2)
    both = flat.T @ dkv.reshape(-1, 2 * DIM)
    g["k"], g["v"] = both[:, :DIM], both[:, DIM:]
    return loss, g


class Steps:
    """Adam over batches of windows as they come, from the weights given."""

    def __init__(self, model: Model, rate: float, batch: int = 128, seed: int = 0) -> None:
        self.model, self.rate, self.batch, self.t = model, rate, batch, 0
        self.draw = np.random.default_rng(seed)
        self.names = sorted(model.weights)
        self.flat = np.concatenate([model.weights[k].ravel() for k in self.names])
        self.w, at = {}, 0
        for k in self.names:
            size = model.weights[k].size
            self.w[k] = self.flat[at: at + size].reshape(model.weights[k].shape)
            at += size
        self.m1, self.m2 = np.zeros_like(self.flat), np.zeros_like(self.flat)

    def take(self, vectors: np.ndarray, inputs: np.ndarray, before: np.ndarray, target: np.ndarray, n: np.ndarray) -> None:
        """One pass over the windows of these texts (see ``class_scores``), in random order."""
        place, empty, places = blocks(n)
        x, c = np.full(places, -1, np.int32), np.full(places, -1, np.int32)
        x[place], c[place] = before, target
        x, c = x.reshape(-1, BLOCK), c.reshape(-1, BLOCK)
        order = self.draw.permutation(np.flatnonzero(~empty))
        for at in range(0, len(order), self.batch):
            o = order[at: at + self.batch]
            _, g = gradients(self.model, self.w, np.take(vectors, np.concatenate((x[o - 1], x[o]), axis=1), axis=0), inputs[x[o]], c[o], empty[o - 1])
            flat = np.concatenate([g[k].ravel() for k in self.names])
            self.t += 1
            self.m1 += 0.1 * (flat - self.m1)
            self.m2 += 0.01 * (flat ** 2 - self.m2)
            self.flat -= (self.rate / (1 - 0.9 ** self.t)) * self.m1 / (np.sqrt(self.m2 / (1 - 0.99 ** self.t)) + 1e-6)


def of_words(model: Model, x: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vector, input row, class) of each word of a batch."""
    return word_vectors(model, x), model.inputs[x.first], model.classes[x.first]


def train(model: Model, batches: DataFrame, rounds: int = 2, shards: int = SHARDS) -> Model:
    """Local steps and averaging, ``rounds`` times, each over its own part of the batches; every training text is in one.

    A task takes the ``encoded`` batches that it reads one by one, at most ``shards`` tasks a round; every
    task starts from the same weights and Spark averages what they come to, by tokens seen.
    """
    sc = batches.sparkSession.sparkContext
    for r in range(rounds):
        sent = sc.broadcast(model)

        def run(rows: Iterator[pa.RecordBatch], r: int = r) -> Iterator[pa.RecordBatch]:
            m = sent.value
            steps, seen = Steps(m, 0.02 / (1 + r), seed=r), 0
            part = TaskContext.get().partitionId()
            for _, held_out, x in decoded(rows, m.path, lambda i: (i + part) % rounds == r):
                training = ~held_out.to_numpy(zero_copy_only=False)
                if training.any():
                    vectors, inputs, classes = of_words(m, x)
                    x = x.some(training)
                    steps.take(vectors, inputs, x.before(), classes[x.every], x.n)
                    seen += len(x.every)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(steps.flat))), pa.array(steps.flat.astype(float) * seen),
                                                  pa.array(np.full(len(steps.flat), float(seen)))], names=["k", "w", "n"])

        got = (batches.coalesce(shards).mapInArrow(run, "k long, w double, n double")
               .groupBy("k").agg((F.sum("w") / F.sum("n")).alias("w")).toArrow())  # one row per weight
        if got.num_rows:
            flat = got.sort_by("k")["w"].to_numpy().astype(np.float32)
            for k in sorted(model.weights):
                size = model.weights[k].size
                model.weights[k], flat = flat[:size].reshape(model.weights[k].shape), flat[size:]
        sent.unpersist()
    return model


# --- scores ---

def above(counted: DataFrame, most: int) -> DataFrame:
    """The most frequent rows, about ``most`` of them and never many more: those over a quantile of n."""
    rows = counted.count()
    if rows <= most:
        return counted
    cut = counted.agg(F.percentile_approx("n", F.lit(1 - most / rows), F.lit(100_000))).first()[0]
    return counted.filter(F.col("n") > cut)


@dataclass
class Learned:
    model: Model
    counts: DataFrame  # word, n; "" is the end
    total: int
    distinct: int
    known: dict[bytes, int]  # counts of the frequent words

    @property
    def floor(self) -> float:
        return float(np.log10(self.total + 0.5 * (self.distinct + 1)))


def learn(batches: DataFrame, path: str, known_words: int = 200_000) -> Learned:
    """Counts, model and trained weights from all training texts of ``encoded`` batches."""
    both = checkpointed(gathered(batches, path))
    counts, beside = both.filter("word IS NOT NULL").select("word", "n"), checkpointed(both.filter("word IS NULL").select("a", "b", "n").coalesce(16))
    sums = counts.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                      F.coalesce(F.sum(F.when(F.octet_length("word") == 0, F.col("n"))), F.lit(0)).alias("ends")).first()
    model = train(build(beside, checkpointed(spelled(counts, path).coalesce(16)), path), batches)
    top = above(counts, known_words).toArrow()
    return Learned(model, counts, int(sums["n"]), int(sums["v"]), {**dict(zip(top["word"].to_pylist(), top["n"].to_pylist())), b"": int(sums["ends"])})


SCORED = ("doc_id string, held_out boolean, n_tokens long, n_known long, base double, score double, "
          "rare array<long>, spelled array<double>, total array<double>")


def score_learned(batches: DataFrame, learned: Learned) -> DataFrame:
    """``encoded`` batches as rows (doc_id as a string, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    floor, discount = learned.floor, learned.model.discount
    sent = batches.sparkSession.sparkContext.broadcast((learned.model, learned.known))  # of fixed size, and known_words

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, counted = sent.value
        for ids, held, x in decoded(rows, model.path):
            words = x.words.as_py().split(b" ")
            vectors, inputs, classes = of_words(model, x)
            count = np.fromiter((counted.get(w, -1) for w in words), np.int64, len(words))
            spelling = model.spelling(x.flat, x.size)
            rare = count < 0
            rare[0] = False
            inside = np.where(rare, 0.0, model.in_class(spelling, classes, count))
            base = np.where(rare, 0.0, np.log10(np.where(rare, 0, count) + 0.5) - floor)
            first = np.cumsum(x.n) - x.n
            total = lambda by_word: np.add.reduceat(by_word[x.every], first)
            score = np.add.reduceat(class_scores(model, vectors, inputs, x.before(), classes[x.every], x.n), first) + total(inside)
            some = x.every[rare[x.every]]
            lists = pa.array(np.append(0, np.cumsum(total(rare.astype(np.int64)))), pa.int32())
            column = lambda by_word: pa.ListArray.from_arrays(lists, pa.array(by_word[some]))
            hashes = np.zeros(len(words), np.int64)
            hashes[rare] = np.fromiter(map(digest, compress(words, rare)), np.uint64, int(rare.sum())).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, held, pa.array(x.n), pa.array(total((count > 0).astype(np.int64))), pa.array(total(base)), pa.array(score / np.log(10)),
                 column(hashes), column(model.unseen(classes) + spelling), column(np.log(np.maximum(model.tokens[classes], 1)))],
                names=[c.split()[0] for c in SCORED.split(", ")])

    scored = checkpointed(batches.mapInArrow(run, SCORED).withColumn("row", F.monotonically_increasing_id()))
    zipped = F.arrays_zip(F.col("rare").alias("h"), F.col("spelled").alias("p"), F.col("total").alias("t"))
    rare = scored.select("row", F.explode(zipped).alias("x")).select("row", "x.h", "x.p", "x.t")
    base = F.log10(F.coalesce(F.col("n"), F.lit(0)) + 0.5) - floor
    by_count = F.log(F.col("n") - discount) - F.col("t")
    word = F.when(F.col("n").isNull(), F.col("p")).otherwise(F.greatest(by_count, "p") + F.log1p(F.exp(-F.abs(by_count - F.col("p")))))
    found = (rare.join(learned.counts.select(F.xxhash64("word").alias("h"), "n"), "h", "left")
             .groupBy("row").agg(F.count("n").alias("more"), F.sum(base).alias("rest"), (F.sum(word) / float(np.log(10))).alias("words")))
    return (scored.drop("rare", "spelled", "total").join(found, "row", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                    F.lit(learned.total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
                    (F.col("score") + F.coalesce("words", F.lit(0.0))).alias("score")))


def score_texts(docs: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                known_words: int = 200_000) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (see the module).

    base_score is a unigram score with counts from all training rows. The counts of about ``known_words``
    frequent words go to every task; a document's other words meet theirs in a shuffle, as 64-bit hashes (two
    of 10^7 words share one with a chance of 3 in a million), with the log-probability of each one's spelling, so
    that every counted word's count is in both scores whatever ``known_words`` is.

    Defined cases: a null or empty text is the end token alone; null ids are not held out unless the
    column says so; without training rows the counts are 0, a class goes by spelling alone and the weights stay at their start;
    repeated rows are scored each; an empty table gives an empty one; other columns are not read.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), held.alias("held_out"))
    batches = checkpointed(encoded(rows, path))
    return score_learned(batches, learn(batches, path, known_words)).withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
