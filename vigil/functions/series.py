"""Column expressions over one per-asset window (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def ffill(c: str | Column, w: Window, limit: int) -> Column:
    """Last non-null value among the current and ``limit`` previous rows."""
    return F.last(c, ignorenulls=True).over(w.rowsBetween(-limit, 0))


def bfill(c: str | Column, w: Window, limit: int) -> Column:
    """First non-null value among the current and ``limit`` following rows."""
    return F.first(c, ignorenulls=True).over(w.rowsBetween(0, limit))


def rolling_mean(c: str | Column, w: Window, size: int) -> Column:
    return F.avg(c).over(w.rowsBetween(-(size - 1), 0))


def rolling_std(c: str | Column, w: Window, size: int) -> Column:
    """Population std of the last ``size`` rows; exactly 0 on a constant frame or one row."""
    frame = w.rowsBetween(-(size - 1), 0)
    std = F.when(F.max(c).over(frame) == F.min(c).over(frame), F.lit(0.0)).otherwise(
        F.stddev_pop(c).over(frame))
    return F.coalesce(std, F.lit(0.0))


def first_diff(c: str | Column, w: Window) -> Column:
    """x_t - x_{t-1}; 0 on the first row of a series (and where either side is missing)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col - F.lag(col, 1).over(w), F.lit(0.0))


def zscore(x: Column, mean: Column, std: Column) -> Column:
    """(x - mean) / std, 0 where std is 0 or missing."""
    return F.coalesce(F.when(std != 0, (x - mean) / std), F.lit(0.0))


def lag_value(c: str | Column, w: Window, k: int) -> Column:
    return F.lag(c, k).over(w)
