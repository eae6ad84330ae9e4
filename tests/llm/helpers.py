"""Small tables and brute-force versions shared by the operator tests."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, n_lines long, fingerprint string, pos int, h string, row long, "
        "x double, part int, score double, word string, `odd name.x` string")
EXTRA = (7, "fp", 3, "h", 5, 0.5, 1, 0.25, "w", "odd")

VOCAB = [a + b + c for a in ("an", "th", "er", "in") for b in ("a", "e", "o") for c in ("nd", "st", "r", "ly")]


def sentence(r: random.Random, n: int) -> str:
    return " ".join(r.choice(VOCAB) for _ in range(n))


def corpus(seed: int = 1, n: int = 40) -> list[tuple]:
    """Rows with null ids, null, empty, blank and long texts, copies, near copies, repeated rows and odd characters."""
    r = random.Random(seed)
    texts: list[str | None] = [sentence(r, r.randint(3, 120)) for _ in range(n)]
    base = sentence(r, 150)
    texts += [base, base, base + " tail", base.replace("and", "xx", 1), None, None, "", "   ", "\n\n \t\n", "Word", "ÄÖ ÉÈ straße İ",
              "x" * 5000, sentence(r, 6000), "a b c \x0bd\x0ce\rf", "A B\nA B\nA B\na b", "the end\r\nthe end\r\n", "\U0001F600 " * 12]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("s0", "s1", None)[i % 3], None if t is None else len(t), *EXTRA) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], rows[n], (None, base, None, None, None, *EXTRA), (None, None, None, None, None, *EXTRA), (None, "lonely null id", None, None, 3, *EXTRA)]
    return rows


def frame(spark, rows, parts: int = 3):
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")
