"""Learned quality rules: an ordered decision list over document statistics, in DataFrame operations.

The statistics are native expressions over the whole text. The list is learned by sequential covering
on all labelled rows: a rule grows by the threshold with the best information gain, is pruned on rows
it was not grown on, and takes away what it covers. Every step is one small aggregation (class counts
per statistic and quantile bin), so the driver only sees counts. The result is a chain of
conditional expressions that Spark evaluates inside code generation.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import SPACE, UPPER, checkpointed, text_or_empty

# The symbols of the n_symbols statistic.
SYMBOLS = "#*$%&|<>"
DIGITS = "0123456789"

#: What rules may test; each is a name and an expression over the statistics' columns.
FEATURES = ("n_words", "mean_word", "symbols_per_char", "upper_per_char", "digits_per_char", "marks_per_word",
            "dup_lines_per_line", "repeat_share", "distinct_share", "words_per_line")


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the five base statistics (long) and the other counts (long), one row per row of ``docs``.

    The stages are separate projections, each used more than once below, so that no array is built twice.
    """
    text = F.col("_t")
    spaced = F.translate(text, SPACE, " " * len(SPACE))
    one = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_t"))
    two = one.select(
        "doc_id",
        _without(text, SPACE).cast("long").alias("word_chars"),
        (F.length(text) - _without(text, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length(text) - _without(text, UPPER)).cast("long").alias("n_upper"),
        (F.length(text) - _without(text, DIGITS)).cast("long").alias("n_digits"),
        (F.length(text) - _without(text, ".,;:!?")).cast("long").alias("n_marks"),
        F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0).alias("_lines"),
        F.transform(F.array_remove(F.split(spaced, " "), ""), lambda w: F.xxhash64(w)).alias("_w"))
    n = F.size("_w")
    # The hash of each window of five words, by place.
    window = F.arrays_zip(*[F.slice("_w", k, F.greatest(n - 4, F.lit(0))).alias(f"w{k}") for k in range(1, 6)])
    three = two.select(
        "doc_id", "word_chars", "n_symbols", "n_upper", "n_digits", "n_marks", n.cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_w")).cast("long").alias("n_distinct"),
        F.transform(window, lambda z: F.xxhash64(z)).alias("_h"))
    # Only texts that repeat a window sort them; equal neighbours in that order are repeated windows.
    four = three.withColumn("_s", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    before = F.concat(F.array(F.lit(None).cast("bigint")), F.col("_s.h"))
    after = F.slice(F.col("_s.h"), 2, F.greatest(F.size("_s"), F.lit(1)))
    repeated = F.filter(F.arrays_zip(F.col("_s").alias("s"), before.alias("b"), after.alias("a")),
                        lambda z: (z["s"]["h"] == z["b"]) | (z["s"]["h"] == z["a"]))
    places = F.sort_array(F.transform(repeated, lambda z: z["s"]["i"]))
    covered = F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda acc, i: F.struct(
        (acc["n"] + i + 5 - F.greatest(i, acc["end"])).alias("n"), (i + 5).alias("end")))
    return four.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered["n"].cast("long").alias("n_repeat_words"),
                       "n_upper", "n_digits", "n_marks", "n_lines", "n_distinct")


def features(stats: DataFrame) -> DataFrame:
    """``stats`` with the columns in FEATURES (double, 0 where a denominator is 0)."""
    over = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0)).cast("double")
    return stats.withColumns({
        "mean_word": over("word_chars", "n_words"), "symbols_per_char": over("n_symbols", "word_chars"),
        "upper_per_char": over("n_upper", "word_chars"), "digits_per_char": over("n_digits", "word_chars"),
        "marks_per_word": over("n_marks", "n_words"), "dup_lines_per_line": over("n_dup_lines", "n_lines"),
        "repeat_share": over("n_repeat_words", "n_words"), "distinct_share": over("n_distinct", "n_words"),
        "words_per_line": over("n_words", "n_lines")})


@dataclass(frozen=True)
class Test:
    """feature <= cut (below) or feature > cut."""

    feature: str
    below: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) <= self.cut if self.below else F.col(self.feature) > self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'<=' if self.below else '>'} {self.cut:.6g}"

Rule = tuple[Test, ...]


def _all(rule: Rule) -> Column:
    out = rule[0].column()
    for t in rule[1:]:
        out = out & t.column()
    return out


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; the first whose tests all hold rejects the document."""

    rules: tuple[Rule, ...]

    def fired(self) -> Column:
        """The number of the rule that rejects the row, from 1; 0 if none does."""
        out = F.lit(0)
        for k in range(len(self.rules), 0, -1):
            out = F.when(_all(self.rules[k - 1]), F.lit(k)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(f"{k}. reject if " + " and ".join(map(str, r)) for k, r in enumerate(self.rules, 1))


def _gain(p0: float, n0: float, p1: float, n1: float) -> float:
    """Information that a test adds for the rows of the target class it keeps."""
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 else -math.inf


def learn(labelled: DataFrame, bad_col: str = "bad", key_col: str = "doc_id", names: tuple[str, ...] = FEATURES, bins: int = 32,
          max_rules: int = 32, max_tests: int = 4, min_precision: float = 0.8, min_cover: int = 5, retries: int = 4) -> DecisionList:
    """A decision list for the rows where ``bad_col`` is true, from all rows of ``labelled``.

    Two thirds of the rows (by hash of the key) grow rules, one third prunes them. For each rule the thresholds are
    taken anew from the rows that no rule covers yet: the ``bins - 1`` quantiles of all of them and those of the target rows among
    them, so that a rare kind of target row has thresholds of its own. A rule must cover ``min_cover``
    target rows with ``min_precision`` on the pruning rows; if it does not, up to ``retries`` more are grown whose first
    tests are on other features or sides before learning ends. A list has at most ``max_rules`` rules of at most ``max_tests`` tests. Without rows
    of both classes the list is empty and rejects nothing.
    """
    if not labelled.columns or labelled.isEmpty():
        return DecisionList(())
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    left = checkpointed(labelled.select(F.col(bad_col).alias("bad"), (F.pmod(F.xxhash64(key_col), F.lit(3)) != 0).alias("grow"),
                                        *[F.col(f).cast("double").alias(f) for f in names]))

    def cuts_of(rows: DataFrame) -> dict[str, list[float]]:
        found = rows.agg(*[F.percentile_approx(which, shares, F.lit(2000)).alias(f"{at}_{f}") for f in names
                           for at, which in (("all", F.col(f)), ("bad", F.when(F.col("bad"), F.col(f))))]).first()
        return {f: sorted({float(x) for at in ("all", "bad") for x in found[f"{at}_{f}"] or ()}) for f in names}

    def bin_of(f: str, cuts: list[float]) -> Column:
        """How many of the feature's cuts lie below its value."""
        return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(f))) if cuts else F.lit(0)

    def binned(rule: list[tuple[str, bool, int]]) -> Column:
        out = F.lit(True)
        for f, below, k in rule:
            out = out & ((F.col(f) <= k) if below else (F.col(f) > k))
        return out

    def grow(rows: DataFrame, cuts: dict[str, list[float]], banned: set) -> list[tuple[str, bool, int]]:
        rule: list[tuple[str, bool, int]] = []
        while len(rule) < max_tests:
            inside = rows.filter(F.col("grow") & binned(rule))
            each = inside.select("bad", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("k")) for f in names])).alias("x"))
            counts: dict[str, dict[int, list[int]]] = {f: {} for f in names}
            for f, k, p, n in each.groupBy("x.f", "x.k").agg(F.count_if("bad"), F.count_if(~F.col("bad"))).collect():  # names x 2 bins rows
                counts[f][k] = [p, n]
            p0 = sum(p for p, _ in counts[names[0]].values())
            n0 = sum(n for _, n in counts[names[0]].values())
            if not p0 or not n0:
                break
            best = (0.0, None)
            for f in names:
                p = n = 0
                for k in range(len(cuts[f])):
                    p, n = p + counts[f].get(k, [0, 0])[0], n + counts[f].get(k, [0, 0])[1]
                    for below, p1, n1 in ((True, p, n), (False, p0 - p, n0 - n)):
                        if p1 >= min_cover and (rule or (f, below) not in banned) and (g := _gain(p0, n0, p1, n1)) > best[0] + 1e-9:
                            best = (g, (f, below, k))
            if best[1] is None:
                break
            rule.append(best[1])
        return rule

    rules: list[Rule] = []
    while len(rules) < max_rules:
        cuts = cuts_of(left)
        rows = checkpointed(left.select("bad", "grow", *[bin_of(f, cuts[f]).cast("short").alias(f) for f in names]))
        banned: set = set()
        accepted = None
        while accepted is None and len(banned) <= retries and (rule := grow(rows, cuts, banned)):
            heads = [rule[:k] for k in range(1, len(rule) + 1)]
            got = rows.filter(~F.col("grow")).agg(*[x for h in heads for x in (
                F.count_if(binned(h) & F.col("bad")), F.count_if(binned(h) & ~F.col("bad")))]).first()
            worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in zip(got[::2], got[1::2])]
            k = max(range(len(heads)), key=lambda i: (worth[i], -i))
            p, n = got[2 * k], got[2 * k + 1]
            if p >= min_cover and p >= min_precision * (p + n):
                accepted = [Test(f, below, cuts[f][b]) for f, below, b in heads[k]]
            else:
                banned.add(rule[0][:2])
        if accepted is None:
            break
        rules.append(tuple(accepted))
        left = left.filter(~_all(tuple(accepted)))
    return DecisionList(tuple(rules))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
          label_col: str = "quality", **how) -> tuple[DataFrame, DecisionList]:
    """Statistics of every row of ``docs`` with ``base_failed``, ``rule`` and ``kept``, and the list that was learnt.

    base_failed: fewer than 10 words, or more than a fifth of the words in windows of five that the
    text repeats. kept: base did not fail and no rule fires. A label of 0 marks rows to reject.

    Defined cases: a null text is empty (0 words, base fails); null ids match no label; a null label is
    no label, and where an id has several the lowest counts; repeated rows are judged each; without
    usable labels the list is empty; empty tables give an empty one; other columns are not read.
    """
    stats = checkpointed(statistics(docs, id_col, text_col))
    one = (labels.select(F.col(label_id_col).alias("doc_id"), F.col(label_col).alias("label")).filter("label IS NOT NULL")
           .groupBy("doc_id").agg(F.min("label").alias("label")))
    ready = features(stats)
    labelled = ready.join(one, "doc_id").withColumn("bad", F.col("label") == 0)
    rules = learn(labelled, "bad", **how)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = ready.withColumn("base_failed", failed).withColumn("rule", rules.fired())
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)), rules
