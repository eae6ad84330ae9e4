"""Distance and density expressions over plain double columns with literal model state."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def sq_dist(cols: Sequence[str], centre: Sequence[float]) -> Column:
    """Squared Euclidean distance between the row and one literal centre."""
    return _sum([(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(cols, centre)])


def nearest(cols: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """struct(d2, cluster) of the nearest centre; ties go to the lowest cluster id."""
    cands = [F.struct(sq_dist(cols, c).alias("d2"), F.lit(k).alias("cluster")) for k, c in enumerate(centres)]
    return cands[0] if len(cands) == 1 else F.least(*cands)


def nearest_distance(cols: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """Euclidean distance to the nearest centre."""
    d2 = [sq_dist(cols, c) for c in centres]
    return F.sqrt(d2[0] if len(d2) == 1 else F.least(*d2))


def logsumexp(terms: Sequence[Column]) -> Column:
    """log Σ exp(t_k), stable: max + log Σ exp(t_k - max)."""
    if len(terms) == 1:
        return terms[0]
    m = F.greatest(*terms)
    return m + F.log(_sum([F.exp(t - m) for t in terms]))


def gaussian_log_terms(cols: Sequence[str], weights: Sequence[float], means: Sequence[Sequence[float]],
                       prec_chol: Sequence[Sequence[Sequence[float]]], log_dets: Sequence[float]) -> list[Column]:
    """log(w_k) + log N(x | mu_k, Sigma_k) for every component.

    ``prec_chol[k]`` is the inverse of the lower Cholesky factor L_k (Sigma_k = L_k L_k^T),
    so the Mahalanobis term is |L_k^{-1}(x - mu_k)|^2; ``log_dets[k]`` = log |Sigma_k|.
    """
    d = len(cols)
    out = []
    for w, mu, p, ld in zip(weights, means, prec_chol, log_dets):
        diffs = [F.col(c) - F.lit(float(m)) for c, m in zip(cols, mu)]
        ys = []
        for i in range(d):
            row = [diffs[j] * F.lit(float(p[i][j])) for j in range(i + 1) if p[i][j] != 0.0]
            ys.append(_sum(row) if row else F.lit(0.0))
        maha = _sum([y * y for y in ys])
        out.append(F.lit(math.log(w) - 0.5 * (d * math.log(2 * math.pi) + ld)) - F.lit(0.5) * maha)
    return out
