"""Drift monitoring: two-sample KS and PSI per sensor, predicted-anomaly rate per period,
training-set sanity. Everything is an aggregate or a distributed running total."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.plans.layout import join_small, running_totals
from vigil.session import checkpointed
from vigil.plans.order_stats import grouped_percentiles


def _long(df: DataFrame, columns: Sequence[str], split: str) -> DataFrame:
    """(split, sensor, value) without nulls — one row per present reading."""
    cast = df.select(split, *[F.col(c).cast("double").alias(c) for c in columns])
    long = cast.unpivot([split], list(columns), "sensor", "value")
    return long.filter(F.col("value").isNotNull())


def drift_ks(df: DataFrame, columns: Sequence[str], split: str = "split", ref: str = "train",
             cur: str = "test") -> DataFrame:
    """Two-sample Kolmogorov–Smirnov statistic per sensor: sup_x |F_ref(x) − F_cur(x)|,
    from running totals over the distinct values (no group is gathered into one task)."""
    long = _long(df, columns, split)
    g = long.groupBy("sensor", (F.col("value") + F.lit(0.0)).alias("value")).agg(
        F.sum((F.col(split) == ref).cast("long")).alias("k_ref"),
        F.sum((F.col(split) == cur).cast("long")).alias("k_cur"))
    cum = running_totals(g, ["value"], ["k_ref", "k_cur"], keys=["sensor"])
    d = cum.withColumnsRenamed({"k_ref_all": "n_ref", "k_cur_all": "n_cur"}).select(
        "sensor", "n_ref", "n_cur",
        F.abs(F.col("k_ref_cum") / F.col("n_ref") - F.col("k_cur_cum") / F.col("n_cur")).alias("_d"))
    return d.groupBy("sensor").agg(F.max("_d").alias("ks_stat"), F.first("n_ref").alias("n_ref"),
                                   F.first("n_cur").alias("n_cur"))


def drift_psi(df: DataFrame, columns: Sequence[str], split: str = "split", ref: str = "train",
              cur: str = "test", bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """Population stability index per sensor over the reference split's quantile bins:
    Σ (q − p)·ln(q / p), shares floored at ``eps``."""
    long = _long(df, columns, split)
    ps = [round(i / bins, 12) for i in range(1, bins)]
    edges = grouped_percentiles(long.filter(F.col(split) == ref), "value", ps, keys=["sensor"]).collect()
    by_sensor: dict[str, list[float]] = {}
    for r in sorted(edges, key=lambda r: (r["sensor"], r["p"])):
        by_sensor.setdefault(r["sensor"], []).append(float(r["percentile"]))
    bucket = None
    for s, es in by_sensor.items():
        b = sum((F.col("value") > F.lit(e)).cast("int") for e in es)
        bucket = F.when(F.col("sensor") == s, b) if bucket is None else bucket.when(F.col("sensor") == s, b)
    counts = long.filter(F.col(split).isin(ref, cur)).groupBy("sensor", bucket.alias("bucket")).agg(
        F.sum((F.col(split) == ref).cast("long")).alias("k_ref"),
        F.sum((F.col(split) == cur).cast("long")).alias("k_cur"))
    tot = counts.groupBy("sensor").agg(F.sum("k_ref").alias("n_ref"), F.sum("k_cur").alias("n_cur"))
    grid = tot.select("sensor", "n_ref", "n_cur", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bucket"))
    j = grid.join(counts, ["sensor", "bucket"], "left")
    p = F.greatest(F.coalesce(F.col("k_ref"), F.lit(0)) / F.col("n_ref"), F.lit(eps))
    q = F.greatest(F.coalesce(F.col("k_cur"), F.lit(0)) / F.col("n_cur"), F.lit(eps))
    return j.groupBy("sensor").agg(F.sum((q - p) * F.log(q / p)).alias("psi"))


def anomaly_rate(df: DataFrame, ts: str, keys: Sequence[str] = (), pred: str = "anomaly_pred",
                 period: str = "day", percentile: float = 99.0) -> DataFrame:
    """Predicted-anomaly rate per period (and keys) against the expected 1 − p/100."""
    expected = 1.0 - percentile / 100.0
    b = F.date_trunc(period, F.col(ts).cast("timestamp")).cast("timestamp_ntz").alias("period")
    g = df.groupBy(b, *keys).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(pred).cast("double")).alias("rate"))
    return g.select("period", *keys, "n_rows", "rate", F.lit(expected).alias("expected_rate"),
                    (F.col("rate") - F.lit(expected)).alias("excess"))


def training_sanity(train: DataFrame, fault: str = "fault_code_true", max_share: float = 0.05) -> DataFrame:
    """Alert when more than ``max_share`` of the (assumed normal) train rows carry a fault."""
    share = F.avg((F.coalesce(F.col(fault), F.lit(0)) != 0).cast("double"))
    return train.agg(F.count(F.lit(1)).alias("n_train"), share.alias("fault_share")).withColumn(
        "alert", F.col("fault_share") > F.lit(max_share))


def ensemble_vote(df: DataFrame, preds: Sequence[str], rule: str = "or", out: str = "anomaly_pred") -> DataFrame:
    """Combine 0/1 predictions: ``or`` / ``and`` / ``majority`` (strictly more than half)."""
    cols = [F.coalesce(F.col(p).cast("int"), F.lit(0)) for p in preds]
    total = sum(cols[1:], cols[0])
    if rule == "or":
        e = total > 0
    elif rule == "and":
        e = total == len(cols)
    elif rule == "majority":
        e = total * 2 > len(cols)
    else:
        raise ValueError(rule)
    return df.withColumn(out, e.cast("int"))


def asset_median_impute(df: DataFrame, asset: str, columns: Sequence[str]) -> DataFrame:
    """Fill missing readings with the asset's exact median of that sensor (documented
    alternative to the bounded fills). Medians: distributed order statistic per (asset,
    sensor); one join of a one-row-per-asset table (AQE broadcasts it when small)."""
    long = df.select(asset, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [asset], list(columns), "sensor", "value")
    med = grouped_percentiles(long, "value", [0.5], keys=[asset, "sensor"])
    wide = med.groupBy(asset).pivot("sensor", list(columns)).agg(F.first("percentile"))
    wide = checkpointed(wide.select(asset, *[F.col(c).alias(f"_med_{c}") for c in columns]))
    j = join_small(df, wide, asset, wide.count(), "left")
    return j.select(*[F.coalesce(F.col(c), F.col(f"_med_{c}")).alias(c) if c in columns else F.col(c)
                      for c in df.columns])
