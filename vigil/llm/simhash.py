"""SimHash near-dedup: 64-bit fingerprints, pigeonhole blocks, verified Hamming distance, components.

Fingerprints of equal value are one class from the start, so copies never pair up. A fingerprint is
cut into ``blocks`` parts; two that differ in at most ``max_bits`` bits agree on ``blocks - max_bits``
of the parts, so each choice of that many parts is a join key. Inside a key's bucket the distances
are checked with numpy, and only edges that span its linked classes leave the task: a bucket of k
classes gives O(k) edges. A bucket beyond ``bucket_rows`` is split by further key bits: its classes
agree on the key, so pigeonhole holds again on the bits that are left. Where that would move more
rows it is dealt out as pairs of chunks, each to a task of its own. So no link is lost and no task
holds a hot bucket whole. Edges are then contracted to components by alternating large-star and
small-star steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import carried, checkpointed, unpacked

SEED = 42
SMALL = 8
#: How often a crowded bucket may be split by further bits before it is dealt out as pairs of chunks.
SPLITS = 3


def fingerprint(text: bytes, words_per_shingle: int = 4) -> int:
    """Unsigned SimHash of the lower-cased words' shingles; 0 if there is no word."""
    words = text.lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    k = min(words_per_shingle, n)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[: n - k + 1].tolist(), ends[k - 1:].tolist())),
                         np.uint64, n - k + 1)
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[at: at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): a hash of the text that tells rows apart, and the fingerprint as a signed long."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(b"" if t is None else bytes(t), words_per_shingle) for t in texts],
                                  np.uint64).view(np.int64))

    fp = F.pandas_udf(run, "long")
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), fp(F.col(text_col).cast("binary")).alias("fp"))


def masks(blocks: int, max_bits: int) -> list[int]:
    """One 64-bit mask for each choice of blocks - max_bits out of ``blocks`` near-equal parts."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, blocks - max_bits)]


def blocks_for(classes: int, max_bits: int) -> int:
    """Enough parts that a join key has more values than there are classes (fewest keys first)."""
    for blocks in range(max_bits + 1, max_bits + 5):
        if 64 * (blocks - max_bits) // blocks >= max(classes, 1).bit_length() + 1:
            return blocks
    return max_bits + 4


def finer(mask: int, max_bits: int) -> list[int]:
    """``mask`` with one of ``max_bits + 1`` near-equal parts of the bits that it leaves out, for each of them."""
    left = [b for b in range(64) if not mask >> b & 1]
    edges = [round(i * len(left) / (max_bits + 1)) for i in range(max_bits + 2)]
    return [mask | sum(1 << b for b in left[a:z]) for a, z in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b))


def _span(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """(member, root) for the linked classes of one bucket, by a search that drops what it reached."""
    out, rest = [], np.unique(fps)
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        front = [root]
        while front and len(rest):
            near = _distance(rest, front.pop()) <= max_bits
            if near.any():
                found = rest[near].tolist()
                front += [np.uint64(x) for x in found]
                out += [(x, int(root)) for x in found]
                rest = rest[~near]
    return out


def _edges(keys: np.ndarray, fps: np.ndarray, table: np.ndarray, all_masks: np.ndarray, max_bits: int) -> np.ndarray:
    """Edges inside runs of equal keys; small runs pair by pair, each pair only under its first block mask (``table``: the rows' own)."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    run = np.repeat(np.arange(len(starts)), sizes)
    small = np.repeat(sizes <= SMALL, sizes)
    found = []
    for step in range(1, SMALL):
        i = np.flatnonzero((run[step:] == run[:-step]) & small[step:])
        if not len(i):
            break
        a, b = fps[i], fps[i + step]
        ok = (_distance(a, b) <= max_bits) & (a != b)
        a, b, t = a[ok], b[ok], table[i][ok]
        if len(a):
            agree = (np.bitwise_xor(a, b)[:, None] & all_masks[None, :]) == 0
            ok = agree.argmax(axis=1) == t
            found.append(np.stack([a[ok], b[ok]], 1))
    for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        if pairs := _span(fps[s: s + n], max_bits):
            found.append(np.array(pairs, np.uint64))
    return np.concatenate(found) if found else np.zeros((0, 2), np.uint64)


def _paired(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """Rows of buckets of n classes as c = n / (bucket_rows / 2) chunks each; every pair of chunks is one group (i, j)."""
    c = F.ceil(F.col("n") / (bucket_rows // 2)).cast("int")
    return (rows.withColumn("mine", F.pmod(F.xxhash64("fp"), c).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), c - 1)))
            .select("root", "t", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp"))


def dealt(classes: DataFrame, max_bits: int, blocks: int, bucket_rows: int) -> DataFrame:
    """(root, t, key, i, j, fp): the classes by groups, so that each close pair shares a group and no group is crowded.

    ``t`` names a mask, ``root`` the block mask it comes from. A bucket of n > ``bucket_rows`` classes is split by finer
    masks if its rows become fewer that way than as pairs of chunks (n^2 / (bucket_rows / 2) of them). That fails only
    for classes that lie within a few bits of each other, and of those there are not many: 22,152 differ from one
    in at most three of 51 bits.
    """
    spark = classes.sparkSession
    every = masks(blocks, max_bits)
    keyed = classes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in every])).alias("t", "key"))
    crowded = checkpointed(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket_rows))
    grouped = [F.col("t").alias("root"), "t", "key", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp"]
    if crowded.isEmpty():
        return keyed.select(*grouped)
    out = keyed.join(crowded, ["t", "key"], "left_anti").select(*grouped)
    hot = checkpointed(keyed.join(crowded, ["t", "key"]).select(F.col("t").alias("root"), "t", "key", "n", "fp"))
    half = bucket_rows // 2

    def rows(n: str):
        return F.when(F.col(n) > bucket_rows, F.col(n) * F.ceil(F.col(n) / half)).when(F.col(n) > 1, F.col(n)).otherwise(0)

    for _ in range(SPLITS):
        children = []
        for t in sorted(r["t"] for r in hot.select("t").distinct().collect()):  # masks, not buckets: bounded by the parameters
            for mask in finer(every[t], max_bits):
                children.append((t, len(every), _signed(mask)))
                every.append(mask)
        known = F.broadcast(spark.createDataFrame(children, "t int, t2 int, mask long"))
        split = checkpointed(hot.join(known, "t").select("root", "t", "key", "n", "t2", F.col("fp").bitwiseAND(F.col("mask")).alias("key2"), "fp"))
        sizes = checkpointed(split.groupBy("t", "key", "t2", "key2").agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n")))
        fewer = checkpointed(sizes.groupBy("t", "key").agg(F.sum(rows("m")).alias("now"), F.max(rows("n")).alias("before"))
                             .filter("now < before").select("t", "key"))
        out = out.unionByName(_paired(hot.join(fewer, ["t", "key"], "left_anti"), bucket_rows))
        met = sizes.join(fewer, ["t", "key"]).filter("m > 1").drop("n")
        inner = checkpointed(split.join(met, ["t", "key", "t2", "key2"])
                             .select("root", F.col("t2").alias("t"), F.col("key2").alias("key"), F.col("m").alias("n"), "fp"))
        out = out.unionByName(inner.filter(F.col("n") <= bucket_rows)
                              .select("root", "t", "key", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp"))
        hot = inner.filter(F.col("n") > bucket_rows)
        if hot.isEmpty():
            return out
    return out.unionByName(_paired(hot, bucket_rows))


def links(classes: DataFrame, max_bits: int, blocks: int, bucket_rows: int = 2000) -> DataFrame:
    """(u, v) edges that connect exactly the classes (column fp) reachable at ``max_bits`` bits."""
    groups = dealt(classes, max_bits, blocks, bucket_rows)
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    order = ["t", "key", "i", "j"]
    lined = groups.repartition(parts, *order).sortWithinPartitions(*order).select(*order, "root", "fp")
    as_array = np.array(masks(blocks, max_bits), np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def done(x: pd.DataFrame) -> pd.DataFrame:
            fps = x["fp"].to_numpy(np.int64).view(np.uint64)
            kk = x[order].to_numpy(np.int64)
            ids = np.concatenate(([0], np.cumsum((kk[1:] != kk[:-1]).any(axis=1)))) if len(kk) else np.zeros(0, np.int64)
            e = _edges(ids, fps, x["root"].to_numpy(np.int64), as_array, max_bits)
            e = np.unique(e, axis=0).view(np.int64)
            return pd.DataFrame({"u": e[:, 0], "v": e[:, 1]})

        for x in batches:
            if not len(x):
                continue
            held.append(x)
            first, last = tuple(held[0][order].iloc[0]), tuple(x[order].iloc[-1])
            if first == last:
                continue  # one bucket so far
            whole = pd.concat(held, ignore_index=True)
            open_run = (whole[order] == pd.Series(last, index=order)).all(axis=1).to_numpy()
            yield done(whole[~open_run])
            held = [whole[open_run]]
        if held:
            yield done(pd.concat(held, ignore_index=True))

    return lined.mapInPandas(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(v, root): each node that has an edge, with the smallest node it can reach.

    Large-star and small-star steps alternate until the edges stay the same; every step is two
    aggregations with map-side minima and a join that adaptive execution can split at a hub.
    """
    hi, lo = F.greatest("u", "v"), F.least("u", "v")
    e = checkpointed(edges.filter("u <> v").select(hi.alias("u"), lo.alias("v")).distinct())
    mark = None
    while True:
        sums = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                     F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("s")).first()
        if tuple(sums) == mark or not sums["n"]:
            return e.select(F.col("u").alias("v"), F.col("v").alias("root"))
        mark = tuple(sums)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpointed(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = checkpointed(large)
        least = checkpointed(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v")
        e = checkpointed(small.distinct())


def near_duplicates(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", blocks: int | None = None, bucket_rows: int = 2000) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) per row: fp and root (a component's name) signed longs, component_id the
    smallest id among all rows whose fingerprints can be reached over links of at most ``max_bits`` bits.

    Defined cases: a null, empty or blank text has fingerprint 0 and links like any other; a text of
    fewer words than a shingle is one shingle; repeated rows and equal texts come out once each with
    equal values; a null id never is a component_id unless the component has no other; an empty
    table gives an empty one; other columns are not read.
    """
    # sized for the cluster: the fingerprint table is narrow (two longs a row) and read three times
    fps = checkpointed(fingerprints(docs, words_per_shingle, id_col, text_col))
    classes = checkpointed(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    edges = links(classes, max_bits, blocks or blocks_for(classes.count(), max_bits), bucket_rows)
    stars = components(edges)
    rooted = (classes.join(stars.withColumnRenamed("v", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    rooted = checkpointed(rooted)
    least = checkpointed(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")))
    named = checkpointed(rooted.select("fp", "root").join(least, "root"))
    return fps.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all columns, that stay if each component keeps one: the smallest id, null ids
    last, then the smallest text hash; of equal rows any one.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **how)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    # A repeated row is counted, so that repetitions are looked for only where there are any.
    first = checkpointed(found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
                         .groupBy("root").agg(F.min_by(F.struct("doc_id", "text_hash", "n"), rank).alias("f"))
                         .select(F.col("f.doc_id").alias("_id"), F.col("f.text_hash").alias("_h"), F.col("f.n").alias("_n")))
    # The rows that go are the narrow side, and mostly the few; texts are shuffled only if those are too many to send.
    gone = found.select("doc_id", "text_hash").join(first, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_h")), "left_anti")
    gone = checkpointed(gone.distinct())
    rows = docs.select(F.col(id_col).alias("_own_id"), F.xxhash64(text_col).alias("_own_h"), F.col(text_col).alias("_text"),
                       carried(docs, [id_col, text_col]).alias("_rest"))
    same = F.col("_own_id").eqNullSafe(F.col("doc_id")) & (F.col("_own_h") == F.col("text_hash"))
    kept = rows.join(gone, same, "left_anti")
    if not first.filter("_n > 1").isEmpty():
        kept = kept.dropDuplicates(["_own_id", "_own_h"])
    return kept.select(*unpacked(kept, "_rest", docs.columns, {id_col: F.col("_own_id"), text_col: F.col("_text")}))
