"""Fingerprints, blocks, links and components against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import EXTRA, UPPER, corpus, empty, frame, sentence, words
from vigil.llm import simhash


def brute_fingerprint(text, k=4):
    w = words((text or "").translate(UPPER))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, max_bits):
    """Smallest index reachable, by plain search."""
    n, seen, out = len(fps), set(), {}
    for i in range(n):
        if i in seen:
            continue
        todo, group = [i], []
        seen.add(i)
        while todo:
            a = todo.pop()
            group.append(a)
            for b in range(n):
                if b not in seen and bin(fps[a] ^ fps[b]).count("1") <= max_bits:
                    seen.add(b)
                    todo.append(b)
        for a in group:
            out[a] = min(group)
    return out


def test_fingerprint_matches_definition():
    for row in corpus():
        text = row[1]
        assert simhash.fingerprint(b"" if text is None else text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_masks_cover_every_close_pair(blocks):
    r = random.Random(blocks)
    all_masks = simhash.masks(blocks, 4)
    for _ in range(300):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), r.randint(0, 4)):
            b ^= 1 << bit
        assert any((a ^ b) & m == 0 for m in all_masks)


def test_span_connects_what_is_linked():
    r = random.Random(2)
    centre = r.getrandbits(64)
    fps = sorted({centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 6))) for _ in range(120)})
    want = brute_components(fps, 4)
    groups = defaultdict(set)
    for i, f in enumerate(fps):
        groups[want[i]].add(f)
    pairs = simhash._span(np.array(fps, np.uint64), 4)
    root = {int(m): int(t) for m, t in pairs}
    for g in groups.values():
        assert len({root.get(f, f) for f in g}) == 1


@pytest.mark.parametrize("blocks,bucket_rows", [(None, 2000), (5, 12), (6, 40)])
def test_near_duplicates_match_brute_force(spark, blocks, bucket_rows):
    r = random.Random(9)
    rows = corpus(n=25)
    base = sentence(r, 200).split()
    for i in range(60):  # near copies: a word changed here and there
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = r.choice(base)
        rows.append((5000 - i, " ".join(w), "en", "s0", 1, *EXTRA))
    got = simhash.near_duplicates(frame(spark, rows), blocks=blocks, bucket_rows=bucket_rows).collect()
    fps = [brute_fingerprint(x[1]) for x in rows]
    comp = brute_components(fps, 4)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[comp[i]].append(rows[i][0])
    least = {c: min((m for m in ids if m is not None), default=None) for c, ids in members.items()}
    key = lambda t: (t[0] is None, t[0] or 0, t[1])
    want = sorted(((rows[i][0], fps[i], least[comp[i]]) for i in range(len(rows))), key=key)
    have = sorted(((x["doc_id"], x["fp"] % (1 << 64), x["component_id"]) for x in got), key=key)
    assert have == want
    assert len(members) < len({f for f in fps})


def test_one_of_each_and_empty_table(spark):
    rows = corpus(n=12)
    kept = simhash.one_of_each(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    comp = brute_components([brute_fingerprint(x[1]) for x in rows], 4)
    got = kept.collect()
    assert len(got) == len(set(comp.values()))
    assert any(x["text"] == "lonely null id" for x in got)
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.one_of_each(empty(spark)).count() == 0


def test_components_of_a_long_path(spark):
    r = random.Random(4)
    order = list(range(60))
    r.shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(59)] + [(100, 101), (101, 100)]
    got = {x["v"]: x["root"] for x in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[v] for v in range(1, 60)} == {0} and got[101] == 100


def linked(edges, nodes):
    """Components of ``nodes`` by union of edges, as a set of frozensets."""
    parent = {f: f for f in nodes}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for u, v in edges:
        parent[top(u)] = top(v)
    groups = defaultdict(set)
    for f in nodes:
        groups[top(f)].add(f)
    return {frozenset(g) for g in groups.values()}


def test_finer_masks_cover_every_close_pair():
    r = random.Random(5)
    for mask in simhash.masks(5, 4) + simhash.finer(simhash.masks(6, 4)[3], 4):
        for _ in range(100):
            a, free = r.getrandbits(64), [b for b in range(64) if not mask >> b & 1]
            b = a ^ sum(1 << x for x in r.sample(free, r.randint(0, 4)))
            assert any((a ^ b) & m == 0 for m in simhash.finer(mask, 4))


@pytest.mark.parametrize("dense", [False, True])
def test_links_of_crowded_buckets_equal_brute_force(spark, dense):
    """Classes that share their low 13 bits: spread over the other bits, or all within six bits of one point."""
    r = random.Random(11)
    centre = r.getrandbits(64)
    fps = {centre}
    while len(fps) < 700:
        base = centre if dense else r.getrandbits(51) << 13 | centre & 0x1FFF
        fps.add(base)
        fps.add(base ^ sum(1 << b for b in r.sample(range(13, 64), r.randint(1, 6))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    got = [(x["u"] % (1 << 64), x["v"] % (1 << 64)) for x in simhash.links(table, 4, 5, bucket_rows=20).collect()]
    every = sorted(fps)
    close = [(a, b) for i, a in enumerate(every) for b in every[i + 1:] if bin(a ^ b).count("1") <= 4]
    assert linked(got, fps) == linked(close, fps)


def test_crowded_bucket_moves_few_rows(spark):
    r = random.Random(12)
    fps = {r.getrandbits(50) << 13 | 5 for _ in range(20000)}
    table = spark.createDataFrame([(f,) for f in fps], "fp long").repartition(3)
    groups = simhash.dealt(table, 4, 5, 2000).groupBy("t", "key", "i", "j").count()
    rows, most = groups.selectExpr("sum(count)", "max(count)").first()
    assert rows < 20 * len(fps) and most <= 2000
