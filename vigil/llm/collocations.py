"""Phrase collocations: suffix pointers sorted by multikey three-way quicksort, to a maximum depth.

Every word of a piece of text starts a suffix of at most ``max_words`` words. A task counts equal suffixes
of what it reads and routes them by their leading words, so that all suffixes that begin alike
meet in one task. There the pointers are partitioned by three-way quicksort on one word after another: the
middle partition of a step holds the pointers equal to the pivot's word, its weight is the count of a phrase and it is
partitioned by the next word; a partition that weighs less than ``min_count`` holds no frequent phrase
and is abandoned.

Leading words that are too frequent for one task, by counts taken first, are routed by the words that follow as
well, up to the first that is not. A phrase of such words alone is counted in parts, which Spark adds up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import LOWER, UPPER, checkpointed

CUT = b"\xff"  # between pieces: no byte of UTF-8
TASK_SUFFIXES = 1_000_000
TASK_WORDS = 2_000_000  # words whose suffixes a task counts together
_BYTES = bytearray(range(256))
for _c in b".,;:!?\n\x0b\x0c\r":
    _BYTES[_c] = CUT[0]
for _a, _b in zip(UPPER.encode(), LOWER.encode()):
    _BYTES[_a] = _b
_BYTES[9] = 32
_BYTES = bytes(_BYTES)


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, with CUT between pieces and at the end."""
    return [] if not text else [*bytes(text).translate(_BYTES).replace(CUT, b" \xff ").split(), CUT]


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, n) of single words, from (lang, text as binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, c in held.items():
                c.pop(CUT, None)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()),
                                                  pa.array(list(c.values()), pa.int64())], names=["lang", "phrase", "n"])
            held.clear()

        for b in batches:
            for lang, text in zip(b["lang"].to_pylist(), b["text"]):
                held.setdefault(lang, Counter()).update(tokens(text.as_py()))
            if sum(map(len, held.values())) > 500_000:
                yield from out()
        yield from out()

    return (docs.mapInArrow(run, "lang string, phrase binary, n long").groupBy("lang", F.col("phrase").cast("string").alias("phrase"))
            .agg(F.sum("n").alias("n")))


def multikey_quicksort(keys: np.ndarray, weight: np.ndarray, least: int, depth: int = 0, starts: np.ndarray | None = None):
    """Yields (depth, pointers, starts, weights) of equal partitions: pointers that agree in the first ``depth`` keys,
    one partition after the other, with the sum of their weights.

    ``keys`` (keys, pointers) are codes, negative where a suffix has ended. All partitions of a step are split at once: each
    by a pivot of its own into less, equal and greater. Partitions that weigh less than ``least`` are abandoned,
    whatever they hold. ``starts`` are the first pointers of partitions that already agree in ``depth`` keys.
    """
    n = keys.shape[1]
    at = np.arange(n)
    starts = np.zeros(min(n, 1), np.int64) if starts is None else starts
    level = np.full(len(starts), depth)
    draw = np.random.default_rng(7)
    while len(at):
        size = np.diff(starts, append=len(at))
        pivot = at[starts + (draw.random(len(starts)) * size).astype(np.int64)]
        pivot = keys[level, pivot]
        seg = np.repeat(np.arange(len(starts)), size)
        own = keys[level[seg], at]
        side = (own > pivot[seg]).astype(np.int64) - (own < pivot[seg]) + 1 + 3 * seg
        own = None
        total = np.bincount(side, weights=weight[at], minlength=3 * len(starts))
        keep = total >= least
        equal = np.arange(len(total)) % 3 == 1
        keep[1::3] &= pivot >= 0  # ended suffixes
        on = keep[side]
        at, side = at[on], side[on]
        order = np.argsort(side, kind="stable")
        at, side = at[order], side[order]
        kept = np.flatnonzero(keep)
        count = np.bincount(side, minlength=len(total))[kept]
        starts = np.cumsum(count) - count
        level = level[kept // 3] + equal[kept]
        # Equal partitions are counts; those at the last key are done.
        found = equal[kept]
        for d in np.unique(level[found]):
            some = found & (level == d)
            members = np.repeat(some, count)
            yield int(d), at[members], np.cumsum(count[some]) - count[some], total[kept[some]].astype(np.int64)
        done = level == len(keys)
        if done.any():
            at = at[np.repeat(~done, count)]
            count, level = count[~done], level[~done]
            starts = np.cumsum(count) - count


def _phrase(words: list[pa.Array]) -> pa.Array:
    """The words of each row with a space between them; nulls are left out, rows of nulls empty."""
    between, parts, before = pa.array([b"", b" "], pa.binary()), [], False
    for w in words:
        there = np.asarray(w.is_valid())
        parts += [between.take(pa.array((before & there).astype(np.int8))), pc.fill_null(w, b"")]
        before = before | there
    return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.binary()))


SUFFIXES = "lang string, lead binary, hot int, n long, rest binary, counts array<long>"


def suffixes(docs: DataFrame, hot: dict[str, set[bytes]], max_words: int) -> DataFrame:
    """(lang, lead, hot, n, rest, counts): the suffixes of a task that begin with the words ``lead``.

    ``rest`` holds what follows ``lead`` in each different suffix, with tabs between them (words hold none), ``counts``
    how often each stands there and ``n`` their sum. ``lead`` goes on to its first word that is not hot;
    ``hot`` is how many hot words it begins with.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[bytes, int] = {CUT: 0}
        held: dict[str, list[np.ndarray]] = {}
        n = 0

        def out() -> Iterator[pa.RecordBatch]:
            names = pa.array(list(ids), pa.binary())
            for lang, parts in held.items():
                is_hot = np.zeros(len(ids) + 1, bool)
                is_hot[[ids[w] for w in hot.get(lang, ()) if w in ids]] = True
                yield from _grouped(lang, np.concatenate(parts), names, is_hot, max_words)

        for b in batches:
            for lang, text in zip(b["lang"].to_pylist(), b["text"]):
                words = tokens(text.as_py())
                held.setdefault(lang, []).append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int32, len(words)))
                n += len(words)
                if n >= TASK_WORDS:
                    yield from out()
                    ids, held, n = {CUT: 0}, {}, 0
        yield from out()

    return docs.mapInArrow(run, SUFFIXES)


def _grouped(lang: str, ids: np.ndarray, names: pa.Array, is_hot: np.ndarray, max_words: int) -> Iterator[pa.RecordBatch]:
    at = np.flatnonzero(ids)
    if not len(at):
        return
    padded = np.concatenate((ids, np.zeros(max_words, np.int32)))
    key, there = ids[at].astype(np.int64), np.ones(len(at), bool)
    for d in range(1, max_words):
        there &= padded[at + d] > 0
        if int(key.max()) >= (1 << 62) // len(names):
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(names) + np.where(there, padded[at + d], 0)
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    at = at[first]
    words = np.stack([padded[at + d] for d in range(max_words)])
    np.multiply(words, np.cumprod(words > 0, axis=0), out=words)  # nothing after a piece's end
    length = (words > 0).sum(axis=0)
    n_hot = np.cumprod(is_hot[words], axis=0).sum(axis=0)
    lead = np.minimum(n_hot + 1, length)
    # Suffixes lie in the order of their words, so equal leads lie together.
    new = np.ones(len(at), bool)
    if len(at) > 1:
        same = lead[1:] == lead[:-1]
        for d in range(max_words):
            same &= (words[d, 1:] == words[d, :-1]) | (lead[1:] <= d)
        new[1:] = ~same
    starts = np.flatnonzero(new)
    offsets = np.append(starts, len(at))
    column = lambda which, on: names.take(pa.array(which, mask=~on))
    leads = _phrase([column(words[d, starts], lead[starts] > d) for d in range(max_words)])
    tails = [column(words[d], (lead <= d) & (length > d)) for d in range(1, max_words)]
    tails = _phrase(tails)
    for i in range(0, len(starts), 50_000):
        o = offsets[i: i + 50_001]
        lists = pa.ListArray.from_arrays(pa.array(o - o[0], pa.int32()), tails.slice(o[0], o[-1] - o[0]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(o) - 1), pa.string()), leads.slice(i, len(o) - 1), pa.array(n_hot[o[:-1]], pa.int32()),
             pa.array(np.add.reduceat(counts[o[0]: o[-1]], o[:-1] - o[0])), pc.binary_join(lists, b"\t"),
             pa.ListArray.from_arrays(pa.array(o - o[0], pa.int32()), pa.array(counts[o[0]: o[-1]]))], names=[c.split()[0] for c in SUFFIXES.split(", ")])


def _codes(column) -> np.ndarray:
    return pc.fill_null(pc.dictionary_encode(column).indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _words_of(column: pa.Array, most: int) -> list[pa.Array]:
    """The 1st, 2nd .. word of space-joined phrases; null where there is none."""
    parts = pc.split_pattern(column, b" ")
    sizes, flat, first = np.diff(parts.offsets.to_numpy()), parts.values, parts.offsets.to_numpy()[:-1]
    return [flat.take(pa.array(first + d, mask=sizes <= d)) for d in range(most)]


def phrase_counts(rows: pa.Table, max_words: int, least: int) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """(languages, phrases, counts) of two words and more in one task's suffixes; of hot words alone, parts of their counts."""
    rows = rows.combine_chunks()
    if not rows.num_rows:
        return
    get = lambda name: rows[name].chunk(0)
    lang, lead, hot, n = get("lang"), get("lead"), get("hot").to_numpy(), get("n").to_numpy()
    words = _words_of(lead, max_words)
    size = sum(np.asarray(w.is_valid()) for w in words)
    for d in range(2, max_words):  # phrases that other tasks count, too
        at = np.flatnonzero((hot >= d) & (size >= d))
        if len(at):
            phrase = _phrase([w.take(pa.array(at)) for w in words[:d]])
            key = _codes(lang.take(pa.array(at))) * (len(at) + 1) + _codes(phrase)
            _, first, group = np.unique(key, return_index=True, return_inverse=True)
            yield lang.take(pa.array(at[first])), phrase.take(pa.array(first)), np.bincount(group, weights=n[at]).astype(np.int64)
    # First by language and first word, over the leads alone: what is abandoned here is never taken apart.
    groups = [(at, starts) for d, at, starts, _ in multikey_quicksort(np.stack((_codes(lang), _codes(words[0]))), n, least) if d == 2]
    if not groups:
        return
    at = np.concatenate([a for a, _ in groups])
    before = np.cumsum([0] + [len(a) for a, _ in groups[:-1]])
    lead_starts = np.concatenate([s + b for (_, s), b in zip(groups, before)])
    rows = rows.take(pa.array(at)).combine_chunks()
    counts = get("counts")
    weight, per_lead = counts.values.to_numpy(), np.diff(counts.offsets.to_numpy())
    tails = pc.split_pattern(get("rest"), b"\t").values
    pointer_lead = np.repeat(np.arange(len(at)), per_lead)
    starts = (np.cumsum(per_lead) - per_lead)[lead_starts]
    # The words after the first: the lead's own, then the rest's.
    led, rest = _words_of(get("lead"), max_words), _words_of(tails, max_words - 1)
    led_size = sum(np.asarray(w.is_valid()).astype(np.int64) for w in led)[pointer_lead]
    empty = np.asarray(pc.equal(tails, b""))
    keys, texts = [], []
    for d in range(1, max_words):
        own = led[d].take(pa.array(pointer_lead))
        for r in range(max_words - 1):  # rest[r] is word led_size + r
            here = pa.array((led_size + r == d) & ~empty)
            own = pc.if_else(here, rest[r], own)
        texts.append(own)
        keys.append(_codes(own))
    hot = get("hot").to_numpy()[pointer_lead]
    for d, at, first, total in multikey_quicksort(np.stack(keys), weight, least, starts=starts):
        some = at[first]
        length = d + 1
        on = (hot[some] < length) | (length == max_words)
        some = pa.array(some[on])
        line = pa.array(pointer_lead[some])
        yield get("lang").take(line), _phrase([led[0].take(line), *(t.take(some) for t in texts[:d])]), total[on]


def counted_phrases(docs: DataFrame, words: DataFrame, total: int, max_words: int, least: int) -> DataFrame:
    """(lang, phrase, n) of all phrases of two to ``max_words`` words that stand ``least`` times or more."""
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-total // TASK_SUFFIXES))
    # At most 4 * parts words can be so frequent: the table sent to the tasks is bounded.
    hot: dict[str, set[bytes]] = {}
    for r in words.filter(F.col("n") > max(total // (4 * parts), least)).select("lang", F.col("phrase").cast("binary").alias("w")).collect():
        hot.setdefault(r["lang"], set()).add(bytes(r["w"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            for lang, phrase, n in phrase_counts(pa.Table.from_batches(held), max_words, least):
                yield pa.RecordBatch.from_arrays([lang, phrase, pa.array(n)], names=["lang", "phrase", "n"])

    return (suffixes(docs, hot, max_words).repartition(parts, "lang", "lead").mapInArrow(run, "lang string, phrase binary, n long")
            .groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


def _cut(phrase: Column, k: int) -> tuple[Column, Column]:
    """The first k words of a phrase, and the others."""
    words = F.split(phrase, " ", -1)
    return F.array_join(F.slice(words, 1, k), " "), F.array_join(F.slice(words, k + 1, F.greatest(F.size(words) - k, F.lit(0))), " ")


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, top: int = 2000, inside: int = 50,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two to ``max_words`` words.

    ``a`` is the count of the phrase, ``l`` and ``r`` those of its parts at the cut with the lowest floor(1000000 a a / (l r)), the score
    (the first such cut), ``n`` all words of the language. A phrase is left out if one that holds it and is a candidate itself stands
    at least ``inside`` percent as often.

    Defined cases: a null text is empty, a null language ``und``. Pieces end at ``.,;:!?`` and line ends; words at spaces and tabs; no
    phrase runs from one piece or document to another. Repeated rows count each. Equal scores and counts go by the bytes of the phrase. A language
    without a candidate has no rows, an empty table neither; other columns are not read. Products are decimals of 38 digits, exact for counts under 10^15.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    words = checkpointed(word_counts(rows))
    sums = words.groupBy("lang").agg(F.sum("n").alias("total"))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    phrases = checkpointed(counted_phrases(rows, words, int(total), max_words, min_count)
                           .withColumn("size", F.size(F.split("phrase", " ", -1))))
    counts = phrases.select("lang", "phrase", "n").unionAll(words.filter(F.col("n") >= min_count).select("lang", "phrase", "n"))
    # Each candidate with its cuts; both parts stand at least as often as it does, so their counts are in the table.
    cuts = F.explode(F.array(*[F.when(F.col("size") > k, F.struct(F.lit(k).alias("k"), *[x.alias(y) for x, y in zip(_cut(F.col("phrase"), k), ("left", "right"))]))
                               for k in range(1, max_words)]))
    cut = phrases.withColumnRenamed("n", "a").withColumn("c", cuts).filter("c is not null").select("lang", "phrase", "size", "a", "c.k", "c.left", "c.right")
    both = (cut.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
            .join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"]))
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    score = F.expr("cast(1000000 as decimal(7,0)) * a2 div lr")
    scored = (both.withColumn("a2", wide("a") * wide("a")).withColumn("lr", wide("l") * wide("r")).withColumn("score", score)
              .groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")))
    # The most frequent longer candidate that holds each phrase.
    held = F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(2), F.greatest(F.col("size") - 1, F.lit(2))), lambda m: F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("size") - m + 1, F.lit(1))), lambda i: F.array_join(F.slice(F.split("phrase", " ", -1), i, m), " "))))))
    longer = (phrases.filter(F.col("size") > 2).select("lang", held.alias("phrase"), F.col("n").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    left = (scored.join(longer, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(inside) * F.col("a")))
            .select("lang", "phrase", "a", "s.l", "s.r", "s.score"))
    # A language may hold most of the phrases: the best of each share first, then the best of those.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    shares = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(shares))).orderBy(*order)
    best = left.withColumn("rank", F.row_number().over(share)).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
