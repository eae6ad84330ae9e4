"""Quality rules (statistics, decision list) and line dedup against plain Python."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import EXTRA, UPPER, corpus, empty, frame, sentence, words
from vigil.llm import line_dedup, quality_rules


def base_statistics(text):
    t = text or ""
    w = words(t)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    twice = {k for k, n in Counter(windows).items() if n > 1}
    covered = {j for i, k in enumerate(windows) if k in twice for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def test_statistics_match_plain_python(spark):
    rows = corpus() + [(900, "a b c d e f a b c d e x a b c d e", None, None, None, *EXTRA),
                       (901, " ".join(["go"] * 3000), None, None, None, *EXTRA), (902, "# * $ | <b> %% && " * 3, None, None, None, *EXTRA)]
    got = quality_rules.statistics(frame(spark, rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    want = [(r[0], *base_statistics(r[1])) for r in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_decision_list_finds_planted_conjunction(spark):
    r = random.Random(3)
    rows = []
    for i in range(900):
        a, b = r.random(), r.random()
        rows.append((i, a, b, r.random(), a > 0.7 and b < 0.4))
    table = spark.createDataFrame(rows, "doc_id long, a double, b double, c double, bad boolean")
    rules = quality_rules.learn(table, names=("a", "b", "c"))
    judged = table.withColumn("rule", rules.fired()).select("bad", (F.col("rule") > 0).alias("out")).collect()
    wrong = sum(x["bad"] != x["out"] for x in judged)
    assert rules.rules and wrong <= 30, str(rules)
    assert "reject if" in str(rules)


def test_decision_list_finds_a_rare_class_beside_a_common_one(spark):
    """A band that holds 2 % of the rows, and a tail with a fifth of them."""
    r = random.Random(5)
    rows = []
    for i in range(3000):
        a, b = r.random(), r.random()
        rows.append((i, a, b, r.random(), 0.50 < a <= 0.52 or b > 0.8))
    table = spark.createDataFrame(rows, "doc_id long, a double, b double, c double, bad boolean")
    rules = quality_rules.learn(table, names=("a", "b", "c"))
    judged = table.withColumn("rule", rules.fired()).select("a", "b", "bad", (F.col("rule") > 0).alias("out")).collect()
    rare = [x for x in judged if 0.50 < x["a"] <= 0.52 and x["b"] <= 0.8]
    assert len(rules.rules) >= 2 and sum(x["out"] for x in rare) >= 0.7 * len(rare), str(rules)
    assert sum(x["out"] and not x["bad"] for x in judged) <= 30, str(rules)


def test_learning_goes_on_after_a_rule_fails(spark, monkeypatch):
    """The best first test is refused by the pruning rows (here: whatever they say of it); the next one is tried."""
    r = random.Random(6)
    rows = [(i, r.random(), r.random(), 0.0) for i in range(900)]
    grown = {x["doc_id"] for x in spark.createDataFrame(rows, "doc_id long, a double, b double, c double")
             .filter(F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0).select("doc_id").collect()}
    # c tells the classes apart in the growing rows alone; a does nearly as well in all.
    rows = [(i, a, b, float(a > 0.6) if i in grown else r.random(), a > 0.6 and b < 0.97) for i, a, b, _ in rows]
    table = spark.createDataFrame(rows, "doc_id long, a double, b double, c double, bad boolean")
    names = ("c", "a")  # of equal gains the first counts
    assert quality_rules.learn(table, names=names, max_tests=1, retries=0).rules == ()
    assert any(t.feature == "a" for rule in quality_rules.learn(table, names=names, max_tests=1).rules for t in rule)


@pytest.mark.parametrize("labels", [[], [(0, 1, 0), (1, 1, 0)], [(None, 0, 0), (5, None, 1)]])
def test_judge_without_two_classes_keeps_by_base_rules_only(spark, labels):
    rows = corpus(n=8)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got, rules = quality_rules.judge(frame(spark, rows), marks)
    assert rules.rules == ()
    assert got.count() == len(rows)
    assert got.filter("kept = base_failed").count() == 0


def test_judge_empty_table(spark):
    got, _ = quality_rules.judge(empty(spark), spark.createDataFrame([], "doc_id long, quality int"))
    assert got.count() == 0


def test_no_python_in_the_plan(spark):
    docs = frame(spark, corpus(n=4))
    for df in (quality_rules.features(quality_rules.statistics(docs)), line_dedup.dedup_lines(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def dedup_lines(rows, least):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    count = Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")})
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if not (key(x) and count[key(x)] >= least)]
        out.append((r[0], "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("hashes", [1_000_000, -1])
def test_line_dedup_matches_plain_python(spark, monkeypatch, hashes):
    monkeypatch.setattr(line_dedup, "BROADCAST_HASHES", hashes)
    r = random.Random(5)
    common = ["Released under a licence.", "  released UNDER a licence.\t", "ÄÖ line", "x"]
    rows = corpus(n=10)
    for i in range(60):
        lines = [sentence(r, 6) for _ in range(r.randint(0, 4))] + [r.choice(common) for _ in range(r.randint(0, 3))] + [""] * r.randint(0, 2)
        r.shuffle(lines)
        rows.append((1000 + i, "\n".join(lines), "en", "s0", 1, *EXTRA))
    got = line_dedup.dedup_lines(frame(spark, rows), min_docs=10)
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and "odd name.x" in got.columns
    have = sorted(((x["doc_id"] is None, x["doc_id"] or 0, x["text"], x["n_lines"], x["n_dropped"]) for x in got.collect()))
    want = sorted((a is None, a or 0, t, n, d) for a, t, n, d in dedup_lines(rows, 10))
    assert have == want
    assert any(d for *_, d in want)


def test_line_dedup_query_digest_and_empty_table(spark, tmp_path):
    from vigil.llm.registry import QUERIES
    spark.createDataFrame([(1, "a\nb"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op2_line_dedup"](spark, str(tmp_path)).collect()}
    assert got[1]["kept_sha256"] == hashlib.sha256(b"a\nb").hexdigest() and got[2]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert (got[2]["n_lines"], got[2]["n_dropped"]) == (1, 0)
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
