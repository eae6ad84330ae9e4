"""Missing-value handling per asset: flags, bounded forward/backward fill, zero sentinel.

Semantics (equal to the reference): a gap of L rows gets its first ``limit`` rows from the
previous value, the last min(limit, L - limit) from the next value (backward fill runs on
the forward-filled series), and the middle L - 2*limit rows become 0.0. With
``causal=True`` the backward fill is skipped, so no row reads the future (streaming-safe).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.config import FILL_LIMIT, TelemetrySpec
from vigil.functions.series import bfill, ffill
from vigil.plans.layout import SeriesLayout, apply_series


def _cols(df: DataFrame, spec: TelemetrySpec, columns: Sequence[str] | None) -> list[str]:
    wanted = spec.fill_columns if columns is None else tuple(columns)
    return [c for c in wanted if c in df.columns]


def nan_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing is null from here on: NaN read from files becomes null."""
    present = set(columns)
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in present else F.col(c)
                       for c in df.columns])


def missing_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<c>_was_nan`` = 1 where ``c`` is missing (call before filling)."""
    present = [c for c in columns if c in df.columns]
    return df.select("*", *[F.col(c).isNull().cast("int").alias(f"{c}_was_nan") for c in present])


def _replace(df: DataFrame, exprs: dict) -> DataFrame:
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def ffill_step(df: DataFrame, layout: SeriesLayout, columns: Sequence[str], limit: int) -> DataFrame:
    w = layout.window()
    return _replace(df, {c: ffill(c, w, limit) for c in columns})


def bfill_step(df: DataFrame, layout: SeriesLayout, columns: Sequence[str], limit: int) -> DataFrame:
    w = layout.window()
    return _replace(df, {c: bfill(c, w, limit) for c in columns})


def zero_sentinel(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Whatever is still missing becomes 0.0."""
    return _replace(df, {c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns if c in df.columns})


def wrangle_steps(df: DataFrame, layout: SeriesLayout, columns: Sequence[str],
                  limit: int = FILL_LIMIT, causal: bool = False, flags: bool = True,
                  sentinel: bool = True) -> DataFrame:
    """Flags → forward fill → backward fill → sentinel, all on one window spec."""
    out = missing_flags(df, columns) if flags else df
    out = ffill_step(out, layout, columns, limit)
    if not causal:
        out = bfill_step(out, layout, columns, limit)
    return zero_sentinel(out, columns) if sentinel else out


def halo(limit: int, causal: bool) -> tuple[int, int]:
    return limit, (0 if causal else limit)


def ffill_limited(df: DataFrame, spec: TelemetrySpec, columns: Sequence[str] | None = None,
                  limit: int = FILL_LIMIT, **plan_kw) -> DataFrame:
    cols = _cols(df, spec, columns)
    return apply_series(df, spec.asset, spec.order, limit, 0,
                        lambda d, lay: ffill_step(d, lay, cols, limit), **plan_kw)


def bfill_limited(df: DataFrame, spec: TelemetrySpec, columns: Sequence[str] | None = None,
                  limit: int = FILL_LIMIT, **plan_kw) -> DataFrame:
    """Forward then backward fill (the backward fill reads the forward-filled series)."""
    cols = _cols(df, spec, columns)
    return apply_series(
        df, spec.asset, spec.order, limit, limit,
        lambda d, lay: bfill_step(ffill_step(d, lay, cols, limit), lay, cols, limit), **plan_kw)


def wrangle(df: DataFrame, spec: TelemetrySpec, columns: Sequence[str] | None = None,
            limit: int = FILL_LIMIT, causal: bool = False, **plan_kw) -> DataFrame:
    """Missing flags + bounded fills + 0 sentinel over sensors and numeric context."""
    cols = _cols(df, spec, columns)
    back, ahead = halo(limit, causal)
    return apply_series(df, spec.asset, spec.order, back, ahead,
                        lambda d, lay: wrangle_steps(d, lay, cols, limit, causal), **plan_kw)


def residual_missing(df: DataFrame, spec: TelemetrySpec, columns: Sequence[str] | None = None,
                     limit: int = FILL_LIMIT, causal: bool = False, **plan_kw) -> DataFrame:
    """Per column: missing before the fill, left after it (before the sentinel), one row each."""
    cols = _cols(df, spec, columns)
    back, ahead = halo(limit, causal)
    filled = apply_series(
        df.select(spec.asset, *spec.order, *[F.col(c).alias(f"_raw_{c}") for c in cols], *cols),
        spec.asset, spec.order, back, ahead,
        lambda d, lay: wrangle_steps(d, lay, cols, limit, causal, flags=False, sentinel=False),
        **plan_kw)
    agg = filled.agg(*[F.sum(F.col(f"_raw_{c}").isNull().cast("long")).alias(f"b_{c}") for c in cols],
                     *[F.sum(F.col(c).isNull().cast("long")).alias(f"a_{c}") for c in cols])
    stack = ", ".join(f"'{c}', b_{c}, a_{c}" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, missing_before, missing_after)")
