"""Data profiling: period summary, missing profile, coverage, frequencies, prevalence,
cross-tabs, anomaly map, ordered previews, deterministic samples and top-k."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.config import TelemetrySpec
from vigil.plans.order_stats import grouped_percentiles


def period_summary(df: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """Rows, columns, time range, distinct assets and regimes — one aggregate."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("int").alias("n_cols"),
            F.min(spec.ts).alias("ts_min"), F.max(spec.ts).alias("ts_max"),
            F.countDistinct(spec.asset).alias("n_assets")]
    if spec.regime and spec.regime in df.columns:
        aggs.append(F.countDistinct(spec.regime).alias("n_regimes"))
    return df.agg(*aggs)


def input_contract(df: DataFrame, spec: TelemetrySpec, expected_rows: int | None,
                   expected_cols: int | None, expected_assets: int | None) -> DataFrame:
    """(check, expected, actual, ok) for rows, columns and assets; also counts null keys."""
    a = df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(spec.asset).alias("assets"),
               F.sum(F.col(spec.asset).isNull().cast("long")).alias("null_keys"))
    ncol = len(df.columns)

    def lit(v):
        return F.lit(v).cast("long")

    checks = ", ".join([
        "'rows', _er, rows",
        "'columns', _ec, _nc",
        "'assets', _ea, assets",
        "'null_asset_ids', CAST(0 AS BIGINT), null_keys",
    ])
    t = a.select("*", lit(expected_rows).alias("_er"), lit(expected_cols).alias("_ec"),
                 lit(ncol).alias("_nc"), lit(expected_assets).alias("_ea"))
    out = t.selectExpr(f"stack(4, {checks}) AS (check, expected, actual)")
    return out.withColumn("ok", F.coalesce(F.col("expected") == F.col("actual"), F.lit(True)))


def assert_contract(contract: DataFrame) -> None:
    bad = contract.filter(~F.col("ok")).collect()
    if bad:
        raise ValueError("input contract violated: " + ", ".join(
            f"{r['check']}={r['actual']} (expected {r['expected']})" for r in bad))


def column_contract(df: DataFrame, spec: TelemetrySpec, need_ts: bool = True, need_asset: bool = True) -> None:
    """Schema-only checks (no job): key columns present, sensors numeric."""
    from pyspark.sql.types import NumericType
    cols = {f.name: f.dataType for f in df.schema.fields}
    if need_ts and spec.ts not in cols:
        raise KeyError(f"column `{spec.ts}` missing")
    if need_asset and spec.asset not in cols:
        raise KeyError(f"column `{spec.asset}` missing")
    bad = [c for c in spec.sensors if c in cols and not isinstance(cols[c], NumericType)]
    if bad:
        raise TypeError(f"non-numeric sensor columns: {bad}")


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Percent missing per column, only columns with any, descending."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"m_{i}") for i, c in enumerate(columns)])
    stack = ", ".join(f"'{c}', m_{i}" for i, c in enumerate(columns))
    long = row.selectExpr(f"stack({len(columns)}, {stack}) AS (column_name, frac)")
    return (long.filter(F.col("frac") > 0)
            .select("column_name", (F.col("frac") * 100.0).alias("pct_missing"))
            .orderBy(F.desc("pct_missing"), "column_name"))


def asset_coverage(df: DataFrame, spec: TelemetrySpec, expected: int | None = None) -> DataFrame:
    """Distribution of samples per asset: count, mean, sample std, min, quartiles, max, and
    how many assets differ from ``expected``. Quartiles by the distributed order statistic."""
    per = df.groupBy(spec.asset).agg(F.count(F.lit(1)).alias("n"))
    q = {r["p"]: r["percentile"] for r in grouped_percentiles(per, "n", [0.25, 0.5, 0.75]).collect()}
    quarter = lambda p: F.lit(q.get(p)).cast("double")
    return per.agg(F.count(F.lit(1)).alias("n_assets"), F.avg("n").alias("mean"), F.stddev_samp("n").alias("std"),
                   F.min("n").cast("long").alias("min"), F.max("n").cast("long").alias("max"),
                   F.sum((F.col("n") != F.lit(expected)).cast("long") if expected is not None
                         else F.lit(0).cast("long")).alias("n_off_expected"),
                   quarter(0.25).alias("p25"), quarter(0.5).alias("p50"), quarter(0.75).alias("p75"))


def value_counts(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Frequencies of several categorical expressions, long form (variable, value, n): one scan,
    one aggregation over (variable, value)."""
    each = F.array(*[F.struct(F.lit(name).alias("variable"), expr.cast("string").alias("value"))
                     for name, expr in columns.items()])
    return df.select(F.explode(each).alias("x")).groupBy("x.variable", "x.value").agg(F.count(F.lit(1)).alias("n"))


def prevalence(df: DataFrame, label: str, fault: str, keys: Sequence[str] = ()) -> DataFrame:
    """Label rate and fault rate (fault ≠ 0), optionally per split."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col(label).cast("double")).alias("label_rate"),
        F.avg((F.coalesce(F.col(fault), F.lit(0)) != 0).cast("double")).alias("fault_rate"))


def crosstab(df: DataFrame, row: str, col: str) -> DataFrame:
    """Long-form cross-tab: count and row-normalised percent (1 decimal). The row total is a
    window over the (small) aggregated table, partitioned by the row key."""
    g = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy(row))
    return g.select(row, col, "n", F.round(F.col("n") * 100.0 / tot, 1).alias("pct_row"))


def anomaly_map(df: DataFrame, spec: TelemetrySpec, pred: str = "anomaly_pred", bucket: str = "hour") -> DataFrame:
    """max(pred) per (asset, time bucket), sparse long form: cells never observed are 0 by
    definition and not materialised (a dense asset × time grid grows as their product)."""
    b = F.date_trunc(bucket, F.col(spec.ts).cast("timestamp")).cast("timestamp_ntz")
    return df.groupBy(spec.asset, b.alias("bucket")).agg(F.max(F.col(pred).cast("int")).alias("max_pred"),
                                                         F.count(F.lit(1)).alias("n_rows"))


def ordered(df: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """Total order (asset, ts, tiebreak) as a global sort (range-partitioned)."""
    return df.orderBy(spec.asset, *spec.order)


def preview(df: DataFrame, spec: TelemetrySpec, n: int = 20) -> DataFrame:
    """First n rows in (asset, time) order — TakeOrderedAndProject, no full sort."""
    return df.orderBy(spec.asset, *spec.order).limit(n)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42, hash_fn: str = "md5") -> DataFrame:
    """n rows without replacement, chosen by the smallest hash of (seed, key): stable under
    any partitioning; ``md5`` matches other engines, ``xxhash64`` is faster."""
    if hash_fn == "md5":
        h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    else:
        h = F.xxhash64(F.col(key), F.lit(seed))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def top_anomalies(df: DataFrame, n: int, score: str = "anomaly_score", key: str = "event_id") -> DataFrame:
    return df.orderBy(F.desc(score), key).limit(n)


def asset_slice(df: DataFrame, spec: TelemetrySpec, asset, label: str | None = None) -> DataFrame:
    """One asset's rows in time order (filter on the partition key reaches the scan)."""
    out = df.filter(F.col(spec.asset) == F.lit(asset))
    if label:
        out = out.withColumn("is_labelled", (F.col(label) == 1).cast("int"))
    return out.orderBy(*spec.order)
