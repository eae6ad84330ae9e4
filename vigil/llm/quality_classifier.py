"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Every text gives a short vector of statistics. The class moments (counts, sums, sums of products) are
added up by Spark over all labelled rows. A class covariance is shrunk towards the pooled one and
that towards a scaled identity; the score comes from the difference of two Mahalanobis log-densities
with Cholesky factors computed once. A logistic curve, fitted to a histogram of those differences over
the labelled rows, turns the difference into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import carried, checkpointed, unpacked

_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#*$%&<>@^~{}[]\\_=+/", "bar": b"|",
            "stop": b".?", "mark": b",;:", "bang": b"!", "line": b"\n", "wide": bytes(range(128, 256))}
_MASKS = np.array([[b in v for b in range(256)] for v in _CLASSES.values()], np.float64)
FEATURES = (*_CLASSES, "length", "word_length", "word_spread", "distinct", "pairs", "top", "lines")


def document_vector(text: bytes) -> np.ndarray:
    """Transformed statistics (logarithms of shares) of one text; an empty text gives a vector too."""
    n = max(len(text), 1)
    shares = _MASKS @ np.bincount(np.frombuffer(text, np.uint8), minlength=256) / n
    words = text.lower().split()
    k = max(len(words), 1)
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    ids: dict[bytes, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    # Of all neighbouring pairs, and of the words after a logarithm: both hardly depend on the length.
    pairs = len(np.unique(at[:-1] * len(ids) + at[1:])) / max(len(words) - 1, 1) if len(words) > 1 else 1.0
    distinct = np.log(max(len(ids), 1) + 1) / np.log(k + 1)
    top = np.bincount(at).max() / k if words else 1.0
    lines = text.split(b"\n")
    rest = [np.log(n), np.log(sizes.mean() + 1), np.log(sizes.std() + 1), distinct, np.log(1.02 - pairs), np.log(top + 0.01),
            np.log(1.02 - len(set(lines)) / len(lines))]
    return np.concatenate((np.log(shares + 0.002), rest))


def _vector_column(text_col: str) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([document_vector(b"" if t is None else bytes(t)) for t in texts])

    return F.pandas_udf(run, "array<double>")(F.col(text_col).cast("binary"))


@dataclass
class Discriminant:
    """Means and Cholesky factors of the two classes, and the logistic curve over their log-density difference."""

    means: np.ndarray
    factors: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density under class 1 less that under class 0, for the rows of x."""
        out = []
        for mean, low in zip(self.means, self.factors):
            z = np.linalg.solve(low, (x - mean).T)
            out.append(-0.5 * (z ** 2).sum(axis=0) - np.log(np.diag(low)).sum())
        return out[1] - out[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.tanh(self.difference(x) / 60) * 60 + self.shift, -40, 40)))


def _moments(labelled: DataFrame, d: int) -> np.ndarray:
    """[class][0]: count, [class][1..d]: sums, then the products' sums; each task gives two rows, Spark adds them by element."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            for y in (0, 1):
                x = np.stack(b["x"][b["y"] == y].to_list()) if (b["y"] == y).any() else np.zeros((0, d))
                total[y] += np.concatenate(([len(x)], x.sum(axis=0), (x.T @ x).ravel()))
        yield pd.DataFrame({"y": [0, 1], "m": list(total)})

    rows = (labelled.select("x", "y").mapInPandas(run, "y int, m array<double>").select("y", F.posexplode("m").alias("k", "m"))
            .groupBy("y", "k").agg(F.sum("m").alias("m")).collect())  # 2 (1 + d + d^2) rows
    out = np.zeros((2, 1 + d + d * d))
    for y, k, m in rows:
        out[y, k] = m
    return out


def fit(labelled: DataFrame, to_pooled: float = 0.2, to_identity: float = 0.02) -> Discriminant | None:
    """Fit on rows (x, y); None unless both classes have rows."""
    d = len(FEATURES)
    m = _moments(labelled, d)
    if not (m[:, 0] > 0).all():
        return None
    n, means = m[:, 0], m[:, 1: d + 1] / m[:, :1]
    own = np.array([m[y, d + 1:].reshape(d, d) / n[y] - np.outer(means[y], means[y]) for y in (0, 1)])
    pooled = (own * (n / n.sum())[:, None, None]).sum(axis=0)
    scale = np.diag(np.diag(pooled)) + 1e-6 * np.eye(d)
    shrunk = (1 - to_identity) * ((1 - to_pooled) * own + to_pooled * pooled) + to_identity * scale + 1e-9 * np.eye(d)
    model = Discriminant(means, np.array([np.linalg.cholesky(s) for s in shrunk]))

    def bins(x: pd.Series) -> pd.Series:
        t = np.tanh(model.difference(np.stack(x.to_list())) / 60) if len(x) else np.zeros(0)
        return pd.Series(np.round(t * 1000).astype(np.int32))

    hist = labelled.select(F.pandas_udf(bins, "int")("x").alias("b"), "y").groupBy("b").agg(
        F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1")).collect()  # 2001 rows at most
    t = np.array([r["b"] for r in hist]) / 1000 * 60
    model.slope, model.shift = _logistic(t, np.array([r["n0"] for r in hist]), np.array([r["n1"] for r in hist]))
    return model


def _logistic(t: np.ndarray, n0: np.ndarray, n1: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps with a little ridge."""
    a, w, x = np.array([0.1, 0.0]), (n0 + n1).astype(float), np.stack([t, np.ones_like(t)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -40, 40)))
        grad = x.T @ (n1 - w * p) - 1e-3 * a
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        a = a + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a[0], 1e-6)), float(a[1])


def learn(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          label_id_col: str = "doc_id", label_col: str = "quality") -> tuple[Discriminant | None, DataFrame]:
    """The model fitted to the labelled rows that are not held out, and the vectors (doc_id, held_out, x) of all rows."""
    held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    at = checkpointed(docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), _vector_column(text_col).alias("x")))
    return fit(checkpointed(_labelled(at, labels, label_id_col, label_col))), at


def _labelled(at: DataFrame, labels: DataFrame, label_id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(x, y) of the rows that are labelled and not held out."""
    one = (labels.select(F.col(label_id_col).alias("doc_id"), F.col(label_col).alias("y")).filter("y IS NOT NULL")
           .groupBy("doc_id").agg(F.min("y").alias("y")))
    return at.filter(~F.col("held_out")).select("doc_id", "x").join(one, "doc_id").select("x", "y")


def score_of(model: Discriminant | None, x: Column) -> Column:
    """The score of a vector column; 0.5 without a model."""

    def run(rows: pd.Series) -> pd.Series:
        if model is None or not len(rows):
            return pd.Series(np.full(len(rows), 0.5))
        return pd.Series(model.score(np.stack(rows.to_list())))

    return F.pandas_udf(run, "double")(x)


def accepted(docs: DataFrame, model: Discriminant | None, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``; nothing is shuffled."""
    def run(texts: pd.Series) -> pd.Series:
        if model is None or not len(texts):
            return pd.Series(np.full(len(texts), 0.5))
        return pd.Series(model.score(np.stack([document_vector(b"" if t is None else bytes(t)) for t in texts])))

    return docs.filter(F.pandas_udf(run, "double")(F.col(text_col).cast("binary")) >= threshold)


def accept(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = 0.3, id_col: str = "doc_id",
           text_col: str = "text", **names) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``, under the model learnt from the labelled rows that are
    not held out. Rows and their vectors are written once, so that texts are read once for learning and scoring; no text is shuffled."""
    held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    rows = checkpointed(docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), _vector_column(text_col).alias("x"), carried(docs, []).alias("_row")))
    model = fit(checkpointed(_labelled(rows, labels, **names)))
    return rows.filter(score_of(model, F.col("x")) >= threshold).select(*unpacked(rows, "_row", docs.columns, {}))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = 0.3, **names) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Rows where ``held_out`` is true are scored but not learnt from. Defined cases: a null text is
    empty; null ids match no label, and are not held out unless the column says so; of several labels
    of an id the lowest counts, null labels are none; repeated rows are scored each; if a class has no
    labelled rows all scores are 0.5; empty tables give an empty one; other columns are not read.
    """
    model, at = learn(docs, labels, held_out, **names)
    out = at.withColumn("score", score_of(model, F.col("x")))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
