"""Evaluation of predictions and scores against partial labels.

All metrics are aggregates; the rank-based ones (ROC-AUC with ties at 1/2, step-wise
average precision, PR curve) come from one table of distinct scores with positive and
negative counts, whose running totals are computed with the distributed prefix sum — no
single-partition window over rows, no collect.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.plans.layout import join_small, running_totals
from vigil.session import checkpointed

def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when den = 0 (zero_division = 0)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def confusion(df: DataFrame, label: str = "anomaly_label", pred: str = "anomaly_pred",
              keys: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp per group (always all four)."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    return df.groupBy(*keys).agg(
        F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
        F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"))


def precision_recall_f1(df: DataFrame, label: str = "anomaly_label", pred: str = "anomaly_pred",
                        keys: Sequence[str] = ()) -> DataFrame:
    c = confusion(df, label, pred, keys)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(*keys, _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
                    _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def score_table(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct scores (−0.0 folded into 0.0) with positive / negative counts, descending
    running totals ``pos_cum`` / ``neg_cum`` (rows with score >= s) and the group's ``pos_all`` /
    ``neg_all``."""
    y = F.col(label).cast("int")
    g = (df.select(*keys, (F.col(score) + F.lit(0.0)).alias("s"), y.alias("_y"))
         .groupBy(*keys, "s").agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") != 1).alias("neg")))
    return running_totals(g, [F.desc("s")], ["pos", "neg"], keys=keys)


def rank_metrics(df: DataFrame, label: str = "anomaly_label", score: str = "anomaly_score",
                 keys: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (Mann–Whitney, ties count 1/2) and average precision per group. Products of
    counts are taken in double: a long overflows at a few billion rows of each class."""
    t = score_table(df, label, score, keys)
    P, N = F.col("pos_all").cast("double"), F.col("neg_all").cast("double")
    below = (F.col("neg_all") - F.col("neg_cum")).cast("double")              # negatives strictly below s
    auc_term = F.col("pos").cast("double") * (below + F.col("neg") / 2.0)
    ap_term = F.when(F.col("pos") > 0, F.col("pos") * (F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum")))).otherwise(0.0)
    agg = t.groupBy(*keys).agg(F.sum(auc_term).alias("_auc"), F.sum(ap_term).alias("_ap"),
                               F.max(P).alias("P"), F.max(N).alias("N"))
    return agg.select(*keys,
                      F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_auc") / (F.col("P") * F.col("N")))
                      .alias("roc_auc"),
                      F.when(F.col("P") > 0, F.col("_ap") / F.col("P")).alias("pr_auc"))


def pr_curve(df: DataFrame, label: str = "anomaly_label", score: str = "anomaly_score",
             keys: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, plus the closing point
    (recall 0, precision 1, no threshold)."""
    t = score_table(df, label, score, keys)
    pts = t.select(*keys, F.col("s").alias("threshold"),
                   (F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum"))).alias("precision"),
                   F.when(F.col("pos_all") > 0, F.col("pos_cum") / F.col("pos_all")).otherwise(F.lit(1.0)).alias("recall"))
    close = t.groupBy(*keys).agg(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                                 F.lit(0.0).alias("recall"))
    return pts.unionByName(close)


def fault_recall(df: DataFrame, fault: str = "fault_code_true", pred: str = "anomaly_pred",
                 keys: Sequence[str] = ()) -> DataFrame:
    """Share of rows with a fault code (≠ 0; null = no fault) predicted anomalous."""
    is_fault = F.coalesce(F.col(fault) != 0, F.lit(False))
    return df.groupBy(*keys).agg(F.avg(F.when(is_fault, F.col(pred).cast("double"))).alias("fault_code_recall"))


def evaluate(df: DataFrame, label: str = "anomaly_label", pred: str = "anomaly_pred",
             score: str = "anomaly_score", fault: str | None = "fault_code_true",
             keys: Sequence[str] = ()) -> DataFrame:
    """One row per group with the 12 reference metrics. With no positive label in a group
    every ratio metric is null (counts are still filled)."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    is_fault = F.coalesce(F.col(fault) != 0, F.lit(False)) if fault else F.lit(False)
    base = df.groupBy(*keys).agg(
        F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
        F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.avg(F.when(is_fault, p.cast("double"))).alias("_fr"))
    ranks = rank_metrics(df, label, score, keys)
    # One row per group on either side: put one below the other and merge, null groups included.
    names = [c for c in [*base.columns, *ranks.columns] if c not in keys]
    j = base.unionByName(ranks, allowMissingColumns=True).groupBy(*keys).agg(*[F.max(c).alias(c) for c in names])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    has_pos = (tp + fn) > 0

    def guard(c: Column) -> Column:
        return F.when(has_pos, c)

    return j.select(
        *keys,
        guard(_ratio(tp, tp + fp)).alias("precision"),
        guard(_ratio(tp, tp + fn)).alias("recall"),
        guard(_ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
        guard(F.col("roc_auc")).alias("roc_auc"),
        guard(F.col("pr_auc")).alias("pr_auc"),
        (tp + fp).alias("n_anomalies_predicted"),
        (tp + fn).alias("n_anomalies_true"),
        guard(F.col("_fr")).alias("fault_code_recall"),
        "tn", "fp", "fn", "tp")


def score_histogram(df: DataFrame, score: str = "anomaly_score", keys: Sequence[str] = (),
                    bins: int = 80) -> DataFrame:
    """Equal-width histogram over each group's own [min, max] (last edge inclusive) with
    density = count / (n · width); a constant group uses [v - 0.5, v + 0.5]. All ``bins``
    bins are returned, empty ones with 0."""
    s = F.col(score) + F.lit(0.0)
    stats = df.groupBy(*keys).agg(F.min(s).alias("_mn"), F.max(s).alias("_mx"), F.count(s).alias("_n"))
    stats = stats.select(*keys, "_n",
                         F.when(F.col("_mx") > F.col("_mn"), F.col("_mn")).otherwise(F.col("_mn") - 0.5).alias("_lo"),
                         F.when(F.col("_mx") > F.col("_mn"), F.col("_mx")).otherwise(F.col("_mx") + 0.5).alias("_hi"))
    if keys:
        gk = list(keys)
        stats = checkpointed(stats)          # one row per group: counted, broadcast under the bound
        j = join_small(df.select(*keys, s.alias("_s")), stats, gk, stats.count())
    else:                                    # one row: its values become literals
        gk = []
        row = stats.first()
        stats = df.sparkSession.createDataFrame([tuple(row)], stats.schema)
        j = df.select(s.alias("_s"), F.lit(row["_lo"]).alias("_lo"), F.lit(row["_hi"]).alias("_hi"))
    b = F.least(F.floor((F.col("_s") - F.col("_lo")) * F.lit(bins) / (F.col("_hi") - F.col("_lo"))),
                 F.lit(bins - 1)).cast("int")
    counts = j.filter(F.col("_s").isNotNull()).groupBy(*gk, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = stats.select(*gk, "_n", "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    out = join_small(grid, counts, [*gk, "bin"], None, "left").select(
        *keys, "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
        (F.coalesce(F.col("count"), F.lit(0)) / (F.col("_n") * width)).alias("density"))
    return out


def threshold_sweep(df: DataFrame, thresholds: Sequence[tuple[float, float]], label: str = "anomaly_label",
                    score: str = "anomaly_score") -> DataFrame:
    """Precision / recall / F1 at several (percentile, threshold) pairs in one pass: one
    conditional-sum column triple per threshold, then unpivot."""
    y = F.col(label).cast("int") == 1
    s = F.col(score)
    aggs = []
    for i, (_, t) in enumerate(thresholds):
        hit = s >= F.lit(float(t))
        aggs += [F.sum((hit & y).cast("long")).alias(f"tp{i}"), F.sum((hit & ~y).cast("long")).alias(f"fp{i}"),
                 F.sum((~hit & y).cast("long")).alias(f"fn{i}")]
    row = df.agg(*aggs)
    stack = ", ".join(f"CAST({p!r} AS DOUBLE), CAST({t!r} AS DOUBLE), tp{i}, fp{i}, fn{i}"
                      for i, (p, t) in enumerate(thresholds))
    long = row.selectExpr(f"stack({len(thresholds)}, {stack}) AS (percentile, threshold, tp, fp, fn)")
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return long.select("percentile", "threshold", _ratio(tp, tp + fp).alias("precision"),
                       _ratio(tp, tp + fn).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
                       (tp + fp).alias("n_pred"))


def best_threshold(df: DataFrame, label: str = "anomaly_label", score: str = "anomaly_score",
                   objective: str = "f1", c_fp: float = 1.0, c_fn: float = 1.0) -> DataFrame:
    """Threshold (a distinct score, flag = score >= t) maximising F1 or minimising
    c_fp·FP + c_fn·FN, from the running-total table; ties → the higher threshold."""
    t = score_table(df, label, score)
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    fn = F.col("pos_all") - tp
    if objective == "f1":
        val = _ratio(2 * tp, 2 * tp + fp + fn)
        order = [F.desc("value"), F.desc("threshold")]
    else:
        val = F.lit(float(c_fp)) * fp + F.lit(float(c_fn)) * fn
        order = [F.asc("value"), F.desc("threshold")]
    scored = t.select(F.col("s").alias("threshold"), val.alias("value"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    return scored.orderBy(*order).limit(1)
