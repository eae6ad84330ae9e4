"""Anomaly scores, thresholds and predictions.

* k-means models score by Euclidean distance to the nearest centre;
* mixture models score by the negative log-density, computed from driver-side Cholesky
  factors as literal arithmetic (log-sum-exp in log space; never from Spark's floored
  ``probability`` column).

Thresholds are percentiles of train scores (exact, via the distributed order statistic).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.vector import gaussian_log_terms, logsumexp, nearest, nearest_distance, sq_dist
from vigil.plans.layout import join_small
from vigil.plans.order_stats import grouped_percentiles, percentile, percentiles
from vigil.session import checkpointed

SCORE = "anomaly_score"
PRED = "anomaly_pred"
CLUSTER = "cluster"

# Native expressions up to this many terms (K * d * d for mixtures); above it the same
# density is computed by NumPy on the feature columns.
MAX_NATIVE_TERMS = 6000


@dataclass(frozen=True)
class CentroidModel:
    columns: tuple[str, ...]
    centres: tuple[tuple[float, ...], ...]
    kind: str = "kmeans"

    @property
    def k(self) -> int:
        return len(self.centres)

    def score_expr(self) -> Column:
        return nearest_distance(self.columns, self.centres)

    def assign_expr(self) -> Column:
        return nearest(self.columns, self.centres).getField("cluster")


@dataclass(frozen=True)
class MixtureModel:
    columns: tuple[str, ...]
    weights: tuple[float, ...]
    means: tuple[tuple[float, ...], ...]
    covs: tuple[tuple[tuple[float, ...], ...], ...]
    ridge: float = 1e-6
    kind: str = "gmm"

    @property
    def k(self) -> int:
        return len(self.weights)

    def factors(self):
        """(inverse lower Cholesky factors, log-determinants) with ``ridge`` on the diagonal."""
        precs, dets = [], []
        d = len(self.columns)
        for cov in self.covs:
            c = np.array(cov, dtype=float) + self.ridge * np.eye(d)
            L = np.linalg.cholesky(c)
            precs.append(np.linalg.inv(L))
            dets.append(2.0 * float(np.sum(np.log(np.diag(L)))))
        return precs, dets

    def log_terms(self) -> list[Column]:
        precs, dets = self.factors()
        return gaussian_log_terms(self.columns, self.weights, self.means,
                                  [p.tolist() for p in precs], dets)

    def native(self) -> bool:
        return self.k * len(self.columns) ** 2 <= MAX_NATIVE_TERMS

    def score_expr(self) -> Column:
        return -logsumexp(self.log_terms())

    def assign_expr(self) -> Column:
        terms = self.log_terms()
        cands = [F.struct((-t).alias("nl"), F.lit(k).alias("cluster")) for k, t in enumerate(terms)]
        return (cands[0] if len(cands) == 1 else F.least(*cands)).getField("cluster")

    def log_density_np(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log p(x), most likely component) for a NumPy batch (Arrow-batch scoring path)."""
        precs, dets = self.factors()
        d = X.shape[1]
        parts = []
        for w, mu, p, ld in zip(self.weights, self.means, precs, dets):
            y = (X - np.asarray(mu)) @ p.T
            parts.append(np.log(w) - 0.5 * (d * np.log(2 * np.pi) + ld) - 0.5 * np.sum(y * y, axis=1))
        a = np.stack(parts, axis=1)
        m = a.max(axis=1, keepdims=True)
        return (m + np.log(np.exp(a - m).sum(axis=1, keepdims=True)))[:, 0], np.argmax(a, axis=1)


def add_score(df: DataFrame, model, score_col: str = SCORE, cluster_col: str | None = None) -> DataFrame:
    """Append the anomaly score (and optionally the assigned cluster)."""
    if isinstance(model, MixtureModel) and not model.native():
        return _score_batches(df, model, score_col, cluster_col)
    if isinstance(model, CentroidModel) and cluster_col:
        # one column per centre distance, then least / argmin over those columns: keeps each
        # generated method small (K·d terms once, not twice) for wide models
        d2 = [sq_dist(model.columns, c).alias(f"_vg_d2_{k}") for k, c in enumerate(model.centres)]
        names = [f"_vg_d2_{k}" for k in range(model.k)]
        near = (F.struct(F.col(names[0]).alias("d2"), F.lit(0).alias("cluster")) if model.k == 1 else
                F.least(*[F.struct(F.col(n).alias("d2"), F.lit(k).alias("cluster")) for k, n in enumerate(names)]))
        return df.select("*", *d2).select(*df.columns, F.sqrt(near.getField("d2")).alias(score_col),
                                          near.getField("cluster").alias(cluster_col))
    extra = [model.score_expr().alias(score_col)]
    if cluster_col:
        extra.append(model.assign_expr().alias(cluster_col))
    return df.select("*", *extra)


def _score_batches(df: DataFrame, model: "MixtureModel", score_col: str, cluster_col: str | None) -> DataFrame:
    """Mixture density by NumPy: for large K·d² the literal expression would not fit into
    generated code. Only the features go to Python; all other columns stay as they are."""
    def run(x: pd.DataFrame) -> pd.DataFrame:
        ld, arg = model.log_density_np(x.to_numpy(dtype=float))
        return pd.DataFrame({"score": -ld, "cluster": arg.astype("int32")})

    density = F.pandas_udf(run, "score double, cluster int")
    out = df.withColumn("_vg_density", density(F.struct(*[F.col(c).cast("double").alias(c) for c in model.columns])))
    extra = [F.col("_vg_density.score").alias(score_col)]
    if cluster_col:
        extra.append(F.col("_vg_density.cluster").alias(cluster_col))
    return out.select(*df.columns, *extra)


def assign_cluster(df: DataFrame, model, cluster_col: str = CLUSTER) -> DataFrame:
    return df.select("*", model.assign_expr().alias(cluster_col))


def threshold_predict(df: DataFrame, threshold: float, score_col: str = SCORE, pred_col: str = PRED) -> DataFrame:
    """1 where score >= threshold (inclusive), else 0."""
    return df.withColumn(pred_col, (F.col(score_col) >= F.lit(float(threshold))).cast("int"))


def only_anomalies(df: DataFrame, pred_col: str = PRED) -> DataFrame:
    return df.filter(F.col(pred_col) == 1)


def fit_threshold(train_scored: DataFrame, p: float = 99.0, score_col: str = SCORE,
                  approx: bool = False) -> float:
    """p-th percentile (0-100) of the train scores."""
    return percentile(train_scored, score_col, p / 100.0, approx=approx)


def score_summary(train_scored: DataFrame, threshold: float, score_col: str = SCORE,
                  approx: bool = False) -> DataFrame:
    """min, p50, p90, max of the train scores and the threshold — one row."""
    p50, p90 = percentiles(train_scored, score_col, [0.5, 0.9], approx=approx)
    mm = train_scored.agg(F.min(score_col).alias("min"), F.max(score_col).alias("max")).first()
    spark = train_scored.sparkSession
    return spark.createDataFrame([(float(mm["min"]), p50, p90, float(mm["max"]), float(threshold))],
                                 "score_min double, score_p50 double, score_p90 double, score_max double, threshold double")


def grouped_threshold(scored: DataFrame, keys: Sequence[str], p: float = 99.0, score_col: str = SCORE,
                      approx: bool = False) -> DataFrame:
    """Per-group p-th percentile of scores: *keys, threshold (per asset / regime / cluster)."""
    q = grouped_percentiles(scored, score_col, [p / 100.0], keys=keys, approx=approx)
    return q.select(*keys, F.col("percentile").alias("threshold"))


def predict_grouped(scored: DataFrame, thresholds: DataFrame, keys: Sequence[str],
                    score_col: str = SCORE, pred_col: str = PRED) -> DataFrame:
    """Join per-group thresholds (one row per group, counted first: broadcast only under the
    bound) and predict. Groups without a threshold (unseen in training) are never flagged."""
    thresholds = checkpointed(thresholds)
    j = join_small(scored, thresholds, list(keys), thresholds.count(), "left")
    return j.withColumn(pred_col, F.coalesce((F.col(score_col) >= F.col("threshold")).cast("int"), F.lit(0)))


def threshold_3sigma(train_scored: DataFrame, score_col: str = SCORE, n_sigma: float = 3.0) -> float:
    row = train_scored.agg(F.avg(score_col).alias("m"), F.stddev_pop(score_col).alias("s")).first()
    return float(row["m"]) + n_sigma * float(row["s"] or 0.0)
