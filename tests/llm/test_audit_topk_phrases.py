"""Filter audit, top-k search and collocations against brute force."""

import random
import re
from collections import Counter
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import UPPER, corpus, empty, frame, words
from vigil.llm import collocations as co
from vigil.llm import filter_audit as fa
from vigil.llm import topk_search as ts

LABELS = "doc_id long, quality int, toxic int, n long, mask int"


# --- filter audit ---

def brute_masks(rows, labels):
    ids = [(r[0], r[1] or "") for r in rows]
    out = []
    for doc_id, text, lang, *_ in rows:
        t = text or ""
        w = words(t)
        failed = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                  "D": bool(re.search("[#$%&*|]", t)), "E": doc_id is not None and any(i is not None and i < doc_id and x == t for i, x in ids)}
        own = [x for x in labels if doc_id is not None and x[0] == doc_id]
        out.append((lang or "", {k for k, v in failed.items() if v}, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    return out


def brute_audit(rows, labels):
    masks, out = brute_masks(rows, labels), {}
    for part in {m[0] for m in masks}:
        docs, summed = [m for m in masks if m[0] == part], Counter()
        for order in permutations("ABCDE"):
            left, gone = docs, []
            for step, f in enumerate(order, 1):
                now = [d for d in left if f in d[1]]
                out[part, "".join(order), step] = [len(left) - len(now), len(now), sum(f in d[1] for d in gone), sum(d[1] == {f} for d in docs),
                                                   sum(d[2] for d in now), sum(d[3] for d in now), f]
                summed[f] += len(now)
                gone, left = gone + now, [d for d in left if f not in d[1]]
        for k in out:
            if k[0] == part:
                out[k][-1] = summed[out[k][-1]]
    return {k: tuple(v) for k, v in out.items()}


def audit_rows(spark, rows, labels):
    got = fa.audit(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got}
    assert len(found) == len(got)
    return found


def test_audit_equals_brute_force(spark):
    rows = corpus(3, 25)
    rows = [(r[0], r[1] and r[1].upper() if i % 7 == 0 else r[1] and r[1] + " #1" if i % 5 == 0 else r[1], *r[2:]) for i, r in enumerate(rows)]
    labels = [(i, int(i % 3 == 0), int(i % 4 == 0), 9, 9) for i in range(0, 40)] + [(0, 1, None, 9, 9), (None, 1, 1, 9, 9), (5, None, 1, 9, 9), (999, 1, 1, 9, 9)]
    found = audit_rows(spark, rows, labels)
    assert found == brute_audit(rows, labels)
    assert {p for p, _, _ in found} == {"en", "fr", ""}
    assert sum(v[1] for k, v in found.items() if k[0] == "" and k[1] == "ABCDE") > 0


def test_audit_of_copies_ties_and_empty_tables(spark):
    copies = [(i, "same text", "en", None, None, *corpus()[0][5:]) for i in range(300)]
    copies += [copies[0]] * 3 + [(None, "same text", "en", None, None, *corpus()[0][5:])]
    found = audit_rows(spark, copies, [])
    # Of equal ids and texts none has a smaller id; nor has a null one.
    assert found["en", "EABCD", 1] == (5, 299, 0, 0, 0, 0, sum(v[1] for k, v in found.items() if k[1][k[2] - 1] == "E"))
    assert fa.audit(empty(spark), spark.createDataFrame([], LABELS)).count() == 0


def test_potentials_are_hart_and_mas_colells():
    r = np.random.default_rng(1)
    masks, n = np.arange(32), r.integers(0, 1000, 32)
    worth = fa.worths(masks, n, 5)
    p = fa.potentials(worth, 5)
    for s in range(1, 32):  # the marginal contributions of a potential add up to the worth
        size = s.bit_count()
        marginal = sum(p[s] - size * p[s ^ (1 << i)] for i in range(5) if s >> i & 1)
        assert marginal == factorial(size) * int(worth[s])
    assert sum(fa.order_sums(worth, 5)) == 120 * int(worth[31])


# --- top-k search ---

VECTORS = "vec_id long, embedding array<float>, label int, row long, id long, score long, rank int, v string"


def brute_top(rows, k, scale=1024):
    good = [(i, vid, [int(np.floor(float(np.float32(x)) * scale)) for x in v]) for i, (vid, v, *_) in enumerate(rows)
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, qid, q in good:
        if qid is not None and qid % 100 == 0:
            scored = sorted(((-sum(a * b for a, b in zip(q, v)), vid is None, vid or 0, vid) for j, vid, v in good if j != i), key=lambda x: x[:3])
            out += [(qid, rank, x[3], -x[0]) for rank, x in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 5, 6, 7, 8, "x") for i, v in rows], VECTORS).repartition(parts)


def top(df, **how):
    return sorted((tuple(r) for r in ts.top_k(df, F.col("vec_id") % 100 == 0, **how).collect()), key=str)


def test_top_k_equals_brute_force(spark, monkeypatch):
    r = np.random.default_rng(2)
    centre = r.standard_normal((5, 8))
    rows = [(i, [float(np.float32(x)) for x in (centre[i % 5] + 0.2 * r.standard_normal(8)) / 3]) for i in range(450)]
    rows += [(i, [0.25] * 8) for i in range(450, 700)]  # a vector held by a third of all rows: ties
    assert top(vectors(spark, rows), k=10) == brute_top(rows, 10)
    assert top(vectors(spark, rows), k=4, query_rows=3) == brute_top(rows, 4)


def test_top_k_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.5]), (0, [0.5, -0.5]), (1, [0.5, -0.5]), (2, None), (3, [None, 0.5]), (4, [nan, 0.1]), (5, [inf, 0.1]), (6, []), (7, [0.3]),
            (8, [0.1, 0.2, 0.9]), (100, [-0.0001, 1.0]), (None, [0.4, 0.4]), (200, None), (300, [0.0, 0.0]), (None, [0.4, 0.4]), (9, [-0.25, 0.75])]
    assert top(vectors(spark, rows), k=3) == brute_top(rows, 3)
    assert top(vectors(spark, rows), k=50) == brute_top(rows, 50)
    assert top(vectors(spark, []), k=3) == []
    assert top(vectors(spark, [(1, [0.5])]), k=3) == []
    assert top(vectors(spark, [(0, [0.5])]), k=3) == []


def test_top_k_is_exact_beyond_53_bits(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in r.standard_normal(4) * 3e4]) for i in range(120)]
    rows += [(i, [30000.0 + 2.0 ** -8 * (i % 3), 1.0, 30000.0, 30000.0]) for i in range(120, 160)]
    assert top(vectors(spark, rows), k=10) == brute_top(rows, 10)
    huge = ts.top_k(vectors(spark, [(0, [3e38, 1.0]), (1, [3e38, 0.0]), (2, [-3e38, 0.0])]), F.col("vec_id") == 0, k=5).collect()
    assert [(x["vec_id"], x["score"]) for x in huge] == [(1, 2 ** 63 - 1), (2, -2 ** 63)]


def test_threshold_stops_early_and_misses_nothing():
    r = np.random.default_rng(4)
    x = np.floor(r.standard_normal((2000, 3)) * 1024)
    block, scored = ts.Block(x, np.arange(2000), np.arange(2000)), 0
    for i in range(20):
        best = ts.Best(5)
        scored += ts.search(block, x[i], i, best)
        s = x @ x[i]
        s[i] = -np.inf
        assert (best.ids == np.lexsort((np.arange(2000), -s))[:5]).all()
        for t in (0, 3, 500):  # no unread vector beats the threshold
            read = np.zeros(2000, bool)
            for d in range(3):
                order = np.argsort(-x[:, d] * np.sign(x[i, d]), kind="stable")
                read[order[:t]] = True
            assert block.threshold(x[i], t) >= (x @ x[i])[~read].max()
    assert scored < 20 * 1000


# --- collocations ---

def brute_phrases(rows, most=3, least=10, best=2000, inside=50):
    f = {}
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, most + 1):
                for i in range(len(w) - size + 1):
                    f.setdefault(lang or "und", Counter())[tuple(w[i: i + size])] += 1
    out = []
    for lang, c in f.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        cand = {k: a for k, a in c.items() if len(k) > 1 and a >= least}
        found = []
        for p, a in cand.items():
            cuts = [(10 ** 6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p))]
            longer = [b for q, b in cand.items() if len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= inside * a for b in longer):
                s, _, left, right = min(cuts)
                found.append((-s, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:best], 1)]
    return sorted(out)


def phrases(df, **how):
    return sorted(tuple(r) for r in co.collocations(df, **how).collect())


def speech(seed, n=120):
    r = random.Random(seed)
    heavy, light = ["the", "of", "und"], ["w%d" % i for i in range(30)]
    rows = []
    for i in range(n):
        text = "".join((r.choice(heavy) if r.random() < 0.5 else r.choice(light)).title() + r.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "!?", "\xa0 "])
                       for _ in range(r.randint(0, 200)))
        rows.append((i, text, ("en", "en", "de", None)[i % 4], None, None, 7, "fp", 3, "h", 5, 0.5, 1, 0.25, "w", "odd"))
    return rows + [rows[1]] * 15 + corpus(5, 5)


@pytest.mark.parametrize("how", [{}, {"max_words": 2}, {"max_words": 4, "min_count": 5, "inside": 80}, {"top": 7, "min_count": 2}])
def test_collocations_equal_brute_force(spark, how):
    rows = speech(1)
    want = brute_phrases(rows, how.get("max_words", 3), how.get("min_count", 10), how.get("top", 2000), how.get("inside", 50))
    assert phrases(frame(spark, rows), **how) == want and len(want) > 20


def test_hot_leading_words_are_split(spark, monkeypatch):
    rows = speech(2)
    docs = frame(spark, rows, 5).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    some = co.suffixes(docs, {"en": {b"the", b"of"}, "de": {b"und"}}, 3).collect()
    leads = {bytes(r["lead"]).decode() for r in some if r["lang"] == "en"}
    assert any(x.startswith("the of ") for x in leads) and "the w1" in leads and "the w1 of" not in leads and "w1" in leads
    # Too small to fill a task, too small a group of words: results stay.
    monkeypatch.setattr(co, "TASK_SUFFIXES", 100)
    assert phrases(frame(spark, rows)) == brute_phrases(rows)


def test_groups_of_words_do_not_matter():
    rows = [("en", (" ".join("abcab"[i % 5] for i in range(k, k + 40))).encode()) for k in range(30)]
    table = lambda parts: pa.Table.from_batches(b for ids, names in parts for b in co._grouped("en", ids, names, np.zeros(9, bool), 3))
    names = [b"\xff", b"a", b"b", b"c"]
    ids = [np.array([names.index(w) for w in co.tokens(t)]) for _, t in rows]
    one = table([(np.concatenate(ids), pa.array(names, pa.binary()))])
    many = table([(i, pa.array(names, pa.binary())) for i in ids])
    found = [sorted((p.as_py(), int(n)) for _, ps, ns in co.phrase_counts(t, 3, 10) for p, n in zip(ps, ns)) for t in (one, many)]
    assert found[0] == found[1] and len(found[0]) > 5


def test_quicksort_partitions():
    r = np.random.default_rng(6)
    keys, weight = r.integers(-1, 12, (3, 3000)), r.integers(1, 4, 3000)
    want = Counter()
    for k, w in zip(keys.T, weight):
        for d in range(1, 4):
            if (k[:d] >= 0).all():
                want[tuple(k[:d])] += int(w)
    got = {}
    for d, at, starts, total in co.multikey_quicksort(keys, weight, 20):
        for group, t in zip(np.split(at, starts[1:]), total):
            assert (keys[:d, group] == keys[:d, group[:1]]).all()
            got[tuple(keys[:d, group[0]])] = int(t)
    assert got == {k: v for k, v in want.items() if v >= 20}


def test_counts_over_64_bits_stay_exact(spark):
    a, left, right = 9_007_199_254_741, 9_007_199_254_745, 9_007_199_254_999
    got = spark.createDataFrame([(a, left, right)], "a long, l long, r long").selectExpr(
        "cast(1000000 as decimal(7,0)) * (cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0))) as s")
    assert got.first()[0] == 10 ** 6 * a * a // (left * right)


def test_no_collocations(spark):
    assert phrases(empty(spark)) == []
    assert phrases(frame(spark, [(1, None, "en", None, None, *corpus()[0][5:])])) == []
