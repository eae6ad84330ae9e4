"""Time split: one global cutoff ``min(ts) + train_days``; train is ``ts < cutoff``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.config import TRAIN_DAYS, TelemetrySpec

SPLIT = "split"


_FMT_SPARK = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_FMT_PY = "%Y-%m-%d %H:%M:%S.%f"


def first_time(df: DataFrame, ts: str) -> dt.datetime:
    """min(ts) as a wall-clock value, formatted by Spark in the session time zone (so the
    Python process time zone never enters)."""
    if ts not in df.columns:
        raise KeyError(f"column `{ts}` missing")
    row = df.agg(F.date_format(F.min(ts), _FMT_SPARK).alias("m")).first()
    if row["m"] is None:
        raise ValueError("empty input: no cutoff")
    return dt.datetime.strptime(row["m"], _FMT_PY)


def ts_lit(df: DataFrame, ts: str, value: dt.datetime):
    """A literal of the time column's own type (with or without zone) for wall-clock ``value``."""
    return F.lit(value.strftime(_FMT_PY)).cast(df.schema[ts].dataType)


def cutoff_of(df: DataFrame, spec: TelemetrySpec, train_days: int = TRAIN_DAYS) -> dt.datetime:
    """min(ts) + train_days (one aggregate reading only the time column)."""
    return first_time(df, spec.ts) + dt.timedelta(days=train_days)


def with_split(df: DataFrame, spec: TelemetrySpec, cutoff) -> DataFrame:
    cut = ts_lit(df, spec.ts, cutoff)
    # a row without a time is in neither split (null)
    return df.withColumn(SPLIT, F.when(F.col(spec.ts) < cut, "train").when(F.col(spec.ts) >= cut, "test"))


def time_split(df: DataFrame, spec: TelemetrySpec, train_days: int = TRAIN_DAYS):
    """(train, test, cutoff). Literal cutoff so both filters can reach the file scan."""
    cut = cutoff_of(df, spec, train_days)
    lit = ts_lit(df, spec.ts, cut)
    return df.filter(F.col(spec.ts) < lit), df.filter(F.col(spec.ts) >= lit), cut


def split_summary(df: DataFrame, spec: TelemetrySpec, cutoff) -> DataFrame:
    """Rows, share of rows and distinct assets per split."""
    tagged = with_split(df.select(spec.ts, spec.asset), spec, cutoff)
    agg = tagged.groupBy(SPLIT).agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.countDistinct(spec.asset).alias("n_assets"))
    # two rows after the aggregate, so a global window costs nothing
    total = F.sum("n_rows").over(Window.partitionBy())
    return agg.select(SPLIT, "n_rows", F.round(F.col("n_rows") * 100.0 / total, 6).alias("pct_rows"),
                      "n_assets")


def temporal_folds(df: DataFrame, spec: TelemetrySpec, first_train_days: int, fold_days: int,
                   n_folds: int) -> DataFrame:
    """Expanding-window folds: fold f trains on [min, min + first + f*step) and validates
    on the next ``fold_days``. Rows are tagged (fold, role); rows outside a fold are dropped."""
    start = first_time(df, spec.ts)
    days = (epoch_seconds(F.col(spec.ts)) - epoch_seconds(ts_lit(df, spec.ts, start))) / 86400.0
    # fold whose validation window holds the row; the row trains every later fold
    v = F.floor((days - first_train_days) / fold_days).cast("int")
    lo = F.greatest(v, F.lit(0))
    folds = F.when(lo <= n_folds - 1, F.sequence(lo, F.lit(n_folds - 1))).otherwise(F.array().cast("array<int>"))
    out = df.withColumn("fold", F.explode(folds))
    return out.withColumn("role", F.when(F.col("fold") == v, "validate").otherwise("train"))


def epoch_seconds(c):
    """Seconds since 1970 of a timestamp (with or without zone; sessions run in UTC)."""
    return F.unix_micros(c.cast("timestamp")) / 1e6
