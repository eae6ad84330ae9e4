"""Walk-forward evaluation: every fold's scaler and threshold from one scan of the features.

Time is cut into blocks: the first training period, then one block per fold. One aggregation gives each block's
count, means and squared deviations; those of a fold's training period are the merged ones of all
blocks before its own. The rows are then read once more: a row is scored under the scaler of each fold that it
belongs to, by its distance to the training mean in scaled space (one centre).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.config import TelemetrySpec
from vigil.operators.evaluate import evaluate
from vigil.operators.scale import Scaler
from vigil.operators.score import PRED, SCORE
from vigil.operators.split import epoch_seconds, first_time, ts_lit
from vigil.plans.order_stats import grouped_percentiles
from vigil.session import checkpointed


@dataclass(frozen=True)
class Moments:
    """Count, means and sums of squared deviations of some rows; two of them merge into those of both."""

    n: np.ndarray
    mean: np.ndarray
    squares: np.ndarray

    def merged(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        share = np.divide(other.n, n, out=np.zeros_like(n), where=n > 0)
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * share, self.squares + other.squares + gap ** 2 * self.n * share)

    def scaler(self, columns: Sequence[str]) -> Scaler:
        std = np.sqrt(np.divide(self.squares, self.n, out=np.zeros_like(self.n), where=self.n > 0))
        return Scaler(tuple(columns), tuple(self.mean.tolist()), tuple(np.where(std > 0, std, 1.0).tolist()))


def time_block(feats: DataFrame, spec: TelemetrySpec, first_train_days: float, fold_days: float):
    """Column: -1 in the first training period, then the number of the fold that validates on the row's time; null without one."""
    start = ts_lit(feats, spec.ts, first_time(feats, spec.ts))
    days = (epoch_seconds(F.col(spec.ts)) - epoch_seconds(start)) / 86400.0
    return F.when(days.isNotNull(), F.greatest(F.floor((days - first_train_days) / fold_days).cast("int"), F.lit(-1)))


def block_moments(feats: DataFrame, block, columns: Sequence[str]) -> dict[int, Moments]:
    """Moments of each block's non-null values, in one aggregation; as many rows as there are blocks."""
    aggs = [a for i, c in enumerate(columns) for a in (F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.var_pop(c).alias(f"v{i}"))]
    out = {}
    for r in feats.groupBy(block.alias("_block")).agg(*aggs).filter("_block IS NOT NULL").collect():
        get = lambda k: np.array([float(r[f"{k}{i}"] or 0.0) for i in range(len(columns))])
        out[r["_block"]] = Moments(get("n"), get("m"), get("v") * get("n"))
    return out


def fold_scalers(moments: dict[int, Moments], columns: Sequence[str], n_folds: int) -> dict[int, Scaler]:
    """The scaler of each fold's training period, merged from the blocks before it; none where there are no rows."""
    out = {}
    for fold in range(n_folds):
        before = [m for b, m in sorted(moments.items()) if b < fold]
        if before:
            out[fold] = reduce(Moments.merged, before).scaler(columns)
    return out


def temporal_cv_metrics(feats: DataFrame, spec: TelemetrySpec, columns: Sequence[str], first_train_days: float, fold_days: float, n_folds: int,
                        percentile: float = 99.0) -> DataFrame:
    """The metrics of ``evaluate`` for the validation rows of each expanding-window fold, and its threshold.

    Fold f trains on all rows before ``first_train_days + f * fold_days`` days and validates on the next
    ``fold_days``. Rows without a time, and folds without training or validation rows, take no part.
    """
    block = time_block(feats, spec, first_train_days, fold_days)
    scalers = fold_scalers(block_moments(feats, block, columns), columns, n_folds)
    if not scalers:
        raise ValueError("no fold has training rows")

    def distance(s: Scaler):
        return F.sqrt(reduce(lambda a, b: a + b, [e * e for e in s.exprs()]))

    scored = F.array(*[F.struct(F.lit(f).alias("fold"), distance(s).alias(SCORE)) for f, s in scalers.items()])
    mine = F.filter(scored, lambda x: x["fold"] >= F.col("_block"))
    rows = (feats.withColumn("_block", block).filter(F.col("_block") < n_folds)
            .select("_block", *[c for c in (spec.label, spec.fault) if c], F.explode(mine).alias("_x")).select("*", "_x.*").drop("_x"))
    rows = checkpointed(rows)
    thresholds = grouped_percentiles(rows.filter(F.col("_block") < F.col("fold")), SCORE, [percentile / 100.0], keys=["fold"])
    known = {int(r["fold"]): float(r["percentile"]) for r in thresholds.collect()}  # one row per fold
    limit = F.element_at(F.create_map(*[x for f, t in known.items() for x in (F.lit(f), F.lit(t))]), F.col("fold"))
    held = rows.filter(F.col("_block") == F.col("fold")).withColumn("threshold", limit).filter("threshold IS NOT NULL")
    held = held.withColumn(PRED, (F.col(SCORE) >= F.col("threshold")).cast("int"))
    return evaluate(held, spec.label, PRED, SCORE, spec.fault, keys=["fold", "threshold"])
