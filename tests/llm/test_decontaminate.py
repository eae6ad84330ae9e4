"""Positional index lookups against brute force: exact windows, proximity, coverage."""

import random
import re

import pytest

from tests.llm.helpers import EXTRA, UPPER, corpus, empty, frame, sentence
from vigil.llm import decontaminate

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(rows, items, window, slop):
    wins = []
    for item, text in items:
        w = terms(text)
        wins += [("null" if item is None else str(item), w[i:i + window]) for i in range(max(1, len(w) - window + 1) if w else 0)]
    out = []
    for r in rows:
        w = terms(r[1])
        hit, found, near = set(), set(), set()
        for item, k in wins:
            for s in range(len(w) - len(k) + 1):
                if w[s:s + len(k)] == k:
                    hit.update(range(s, s + len(k)))
                    found.add(item)
                elif w[s] == k[0] and all(k[o] in w[max(0, s + o - slop):s + o + slop + 1] for o in range(1, len(k))):
                    near.add(item)
        out.append((r[0], len(w), len(hit), sorted(found), sorted(near - found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block_bytes", [16_000_000, 300])
def test_matches_brute_force(spark, block_bytes):
    r = random.Random(1)
    items = [(i, sentence(r, n)) for i, n in enumerate((30, 13, 14, 5, 1, 20, 40))] + [(None, sentence(r, 15)), (50, None), (51, "!!"), (3, sentence(r, 18))]
    rows = corpus(n=10)
    for i in range(30):
        text = sentence(r, r.randint(0, 60)).split()
        item = terms(r.choice([t for _, t in items if t]))
        part = item[r.randint(0, max(0, len(item) - 13)):][: r.choice((13, 13, 20, 12, 50))]
        if r.random() < 0.3 and len(part) > 6:  # a word out of place: near, not exact
            part[3], part[4] = part[4], part[3]
        at = r.randint(0, len(text))
        sep = r.choice((" ", "-", ", ", "\n"))
        rows.append((2000 + i, sep.join(text[:at] + [x.upper() if r.random() < .3 else x for x in part] + text[at:]), "en", "s", 1, *EXTRA))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(frame(spark, rows), bench, slop=2, block_bytes=block_bytes)
    have = [(x["doc_id"], x["n_words"], x["n_hit"], x["items"], x["near_items"], x["contaminated"]) for x in got.collect()]
    want = brute(rows, items, 13, 2)
    key = lambda t: (t[0] is None, t[0] or 0, t[1:])
    assert sorted(have, key=key) == sorted(want, key=key)
    assert any(x[5] for x in want) and any(x[4] for x in want)


def test_small_segments_and_empty_tables(spark):
    rows = corpus(n=6)
    index = decontaminate.build_index(frame(spark, rows, 2), segment_tokens=500)
    assert index.count() > 4
    assert sum(len(x["ids"]) for x in index.collect()) == len(rows)
    bench = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(frame(spark, rows), bench)
    assert got.count() == len(rows) and got.filter("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.contamination(empty(spark), bench).count() == 0
