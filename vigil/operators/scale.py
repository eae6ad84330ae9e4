"""Standardisation (fit on train only) and optional PCA.

The fitted state is model-sized (two numbers per feature, or a d × n loading matrix), so it
is collected once and applied as literal arithmetic: the transform stays inside
whole-stage codegen instead of going through ``VectorUDT``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.plans.sums import array_sums


@dataclass(frozen=True)
class Scaler:
    columns: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]          # population std; 1.0 where the std is 0

    def exprs(self, prefix: str = "") -> list:
        return [((F.col(c) - F.lit(m)) / F.lit(s)).alias(prefix + c)
                for c, m, s in zip(self.columns, self.mean, self.scale)]

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        """Replace (or, with ``prefix``, add) the feature columns by their scaled values."""
        scaled = {prefix + c: e for c, e in zip(self.columns, self.exprs(prefix))}
        if prefix:
            return df.select("*", *scaled.values())
        return df.select(*[scaled.get(c, F.col(c)) for c in df.columns])

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, c, m, s) for i, (c, m, s) in enumerate(zip(self.columns, self.mean, self.scale))]
        return spark.createDataFrame(rows, "idx int, feature string, mean double, scale double")

    @staticmethod
    def from_df(df: DataFrame) -> "Scaler":
        rows = sorted(df.collect(), key=lambda r: r["idx"])
        return Scaler(tuple(r["feature"] for r in rows), tuple(r["mean"] for r in rows),
                      tuple(r["scale"] for r in rows))


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """Mean and population std of every feature in one aggregate (partial + final)."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    row = train.agg(*aggs).first()
    mean = tuple(float(row[f"m{i}"] or 0.0) for i in range(len(columns)))
    scale = tuple(float(row[f"s{i}"]) if row[f"s{i}"] else 1.0 for i in range(len(columns)))
    return Scaler(tuple(columns), mean, scale)


@dataclass(frozen=True)
class Projection:
    """PCA: x ↦ (x - mean) · components; ``components[j]`` is the loading vector of pj."""

    columns: tuple[str, ...]
    mean: tuple[float, ...]
    components: tuple[tuple[float, ...], ...]
    explained_variance_ratio: tuple[float, ...]

    @property
    def output_columns(self) -> list[str]:
        return [f"p{j}" for j in range(len(self.components))]

    def exprs(self) -> list:
        out = []
        for j, comp in enumerate(self.components):
            terms = [(F.col(c) - F.lit(m)) * F.lit(w) for c, m, w in zip(self.columns, self.mean, comp)]
            e = terms[0]
            for t in terms[1:]:
                e = e + t
            out.append(e.alias(f"p{j}"))
        return out

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return df.select(*keep, *self.exprs())


def co_moments(df: DataFrame, columns: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, population covariance) in one pass over the rows, as sums about the first row's values."""
    d = len(columns)
    first = df.select(*[F.col(c).cast("double") for c in columns]).first()
    if first is None:
        raise ValueError("no rows")
    shift = np.array([v or 0.0 for v in first])
    upper = np.triu_indices(d)

    def add(x: np.ndarray) -> np.ndarray:
        y = x - shift
        return np.concatenate(([len(y)], y.sum(axis=0), (y.T @ y)[upper]))

    total = array_sums(df, columns, add, 1 + d + len(upper[0]))
    n, s1 = total[0], total[1: 1 + d] / total[0]
    cov = np.zeros((d, d))
    cov[upper] = total[1 + d:] / n
    cov = cov + np.triu(cov, 1).T - np.outer(s1, s1)
    return int(n), s1 + shift, cov


def subspace_iteration(cov: np.ndarray, start: np.ndarray, steps: int) -> np.ndarray:
    """Orthonormal rows after ``steps`` multiplications of the rows of ``start`` by ``cov``, each followed by Gram-Schmidt."""
    q = np.asarray(start, float)
    for _ in range(steps):
        y = q @ cov
        q = np.zeros_like(y)
        for j, v in enumerate(y):
            v = v - (q[:j] @ v) @ q[:j]
            q[j] = v / np.linalg.norm(v)
    return q


def _projection(columns: Sequence[str], mean: np.ndarray, cov: np.ndarray, comps: np.ndarray) -> Projection:
    explained = np.einsum("ij,jk,ik->i", comps, cov, comps) / max(float(np.trace(cov)), 1e-300)
    return Projection(tuple(columns), tuple(mean.tolist()), tuple(map(tuple, comps.tolist())), tuple(explained.tolist()))


def pca_fixed_steps(train: DataFrame, columns: Sequence[str], start: Sequence[Sequence[float]], steps: int) -> Projection:
    """``steps`` of subspace iteration from the given rows; the same result for the same rows, whatever their layout."""
    _, mean, cov = co_moments(train, columns)
    return _projection(columns, mean, cov, subspace_iteration(cov, np.asarray(start, float), steps))


def fit_pca(train: DataFrame, columns: Sequence[str], k: int) -> Projection:
    """Principal components of the (centred) train rows, from one pass of co-moments; the decomposition is
    model-sized. Signs are fixed (largest |loading| positive) so refits are comparable."""
    _, mean, cov = co_moments(train, columns)
    values, vectors = np.linalg.eigh(cov)
    comps = vectors[:, np.argsort(-values, kind="stable")[:k]].T
    for j in range(comps.shape[0]):
        if comps[j, np.argmax(np.abs(comps[j]))] < 0:
            comps[j] = -comps[j]
    return _projection(columns, mean, cov, comps)
