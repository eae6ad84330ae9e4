"""Permutation, shard and slot; packing round trips."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import EXTRA, corpus, empty, frame, sentence
from vigil.llm import packing, sharding
from vigil.llm.bpe import BytePairs


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000, 4097])
def test_feistel_is_a_permutation_with_inverse(n):
    f = sharding.Feistel(n, seed=3)
    p = f.permute(np.arange(n))
    assert sorted(p) == list(range(n))
    assert (f.invert(p) == np.arange(n)).all()
    if n > 16:
        assert (p != sharding.Feistel(n, seed=4).permute(np.arange(n))).any()
        assert sharding.locate(*sharding.place(5, n, 7, 3), n, 7, 3) == 5


@pytest.mark.parametrize("parts", [1, 5])
def test_shards_are_even_gapless_and_do_not_depend_on_the_layout(spark, parts):
    rows = corpus()
    got = sharding.shard_rows(frame(spark, rows, parts), shards=7).select("doc_id", "text", "row", "shard", "slot", "lang").collect()
    assert sorted(x["row"] for x in got) == list(range(len(rows)))
    slots = defaultdict(list)
    for x in got:
        slots[x["shard"]].append(x["slot"])
        assert (x["shard"], x["slot"]) == sharding.place(x["row"], len(rows), 7, 20)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(7)]
    assert max(sizes) - min(sizes) <= 1
    ids = sorted((x["row"], x["doc_id"] is not None, x["doc_id"] or 0) for x in got)
    assert [i[1:] for i in ids] == sorted(i[1:] for i in ids)
    assert sharding.shard_rows(empty(spark)).count() == 0


def test_ids_equal_the_tokenizers_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    fast, whole = BytePairs(path), Tokenizer.from_file(path)
    assert fast.fast is not None
    texts = [r[1] or "" for r in corpus()] + ["a  b", " lead", "trail ", "x \n y", "it's we'll 12 34.5, don't IT'S", "<|endoftext|> a b c", "a\u3000 b\x1cc\x85 d",
                                              "tab\t x y z", "\u00bd \u2167 \u0e01\u0e33 e\u0301", "\r\n\r\n  \n", "\x00\x01"]
    for t in texts:
        assert fast.encode(t) == whole.encode(t, add_special_tokens=False).ids, t


def test_fill_keeps_every_limit():
    r = random.Random(6)
    need = np.array([(t := r.randint(1, 99), 1, r.randint(0, t)) for _ in range(300)])
    limits = np.array([100, 5, 60])
    bins = packing.fill(need, limits)
    taken = Counter()
    for b in bins:
        assert sum(t for _, t in b) <= 100 and len(b) <= 5
        for i, t in b:
            taken[i] += t
    assert all(taken[i] == need[i, 0] for i in range(300))


def brute_ids(rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [(r[0], [*t.encode(r[1] or "", add_special_tokens=False).ids, 1]) for r in rows]


@pytest.mark.parametrize("how", [{}, {"max_tokens": 128, "max_segments": 4}, {"max_tokens": 100, "max_loss": 40, "max_segments": 6}])
def test_packing_round_trip(spark, how):
    r = random.Random(8)
    rows = [x for x in corpus() if x[0] is not None][:-3] + [(3000 + i, sentence(r, r.randint(0, 40)), "en", "s", 1, *EXTRA) for i in range(120)]
    got = [x.asDict() for x in packing.pack(frame(spark, rows, 2), **how).collect()]
    most = how.get("max_tokens", 2048)
    by_doc = defaultdict(list)
    by_sequence = defaultdict(list)
    for x in got:
        by_doc[x["doc_id"]].append(x)
        by_sequence[x["sequence_id"]].append(x)
    for doc, ids in brute_ids(rows):
        at = 0
        for x in sorted(by_doc[doc], key=lambda x: x["start"]):
            assert x["start"] == at and x["doc_tokens"] == len(ids) and x["length"] > 0
            assert x["ids_crc32"] == zlib.crc32(np.array(ids[at: at + x["length"]], "<u4").tobytes())
            at += x["length"]
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    waste = 0
    for pieces in by_sequence.values():
        at = 0
        for x in sorted(pieces, key=lambda x: x["offset"]):
            assert x["offset"] == at
            at += x["length"]
        assert at <= most and at == pieces[0]["sequence_length"] and len(pieces) <= how.get("max_segments", 256)
        assert sum(x["loss_tokens"] for x in pieces) <= how.get("max_loss", most)
        waste += most - at if at & (at - 1) else 0
    if not how:
        assert waste == 0


def test_packing_nulls_repeats_prompts_and_empty_table(spark):
    rows = [(None, "a b c"), (None, None), (1, "x"), (1, "x"), (9007199254740993, "big id")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    whole = [x for x in got if x["start"] == 0]  # the last sequences are cut into powers of two
    assert sorted((x["doc_id"] or -1) for x in whole) == sorted([-1, -1, 1, 1, 9007199254740993])
    mixed = spark.createDataFrame([(1, "a b c", True), (2, "d e f", False), (3, "g", None)], "doc_id long, text string, answer boolean")
    loss = Counter()
    for x in packing.pack(mixed, loss_col="answer").collect():
        loss[x["doc_id"]] += x["loss_tokens"]
    assert loss[2] == 0 and loss[3] == 0 and loss[1] > 0
    assert packing.pack(empty(spark)).count() == 0
