"""Look-back time-series features per asset and the modelling feature list.

For each sensor: rolling mean and population std over the last ``window`` rows (rows, not
minutes), first difference, and the local z-score. All 4 × sensors columns are produced by
one projection over one window spec, so the plan has one Exchange and one Sort.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.config import FILL_LIMIT, ROLLING_WINDOW, TelemetrySpec
from vigil.functions.series import first_diff, lag_value, rolling_mean, rolling_std, zscore
from vigil.operators.wrangle import halo, wrangle_steps
from vigil.plans.layout import SeriesLayout, apply_series


def derived_names(sensors: Sequence[str], add_diff: bool = True, add_zscore: bool = True) -> list[str]:
    """Generated column names in modelling order: (mean, std) per sensor, diffs, z-scores."""
    names = [n for s in sensors for n in (f"{s}_roll_mean", f"{s}_roll_std")]
    if add_diff:
        names += [f"{s}_diff" for s in sensors]
    if add_zscore:
        names += [f"{s}_zscore" for s in sensors]
    return names


def feature_steps(df: DataFrame, layout: SeriesLayout, sensors: Sequence[str],
                  window: int = ROLLING_WINDOW, add_diff: bool = True,
                  add_zscore: bool = True) -> DataFrame:
    w = layout.window()
    sensors = [s for s in sensors if s in df.columns]
    exprs = []
    for s in sensors:
        exprs += [rolling_mean(s, w, window).alias(f"{s}_roll_mean"),
                  rolling_std(s, w, window).alias(f"{s}_roll_std")]
    if add_diff:
        exprs += [first_diff(s, w).alias(f"{s}_diff") for s in sensors]
    out = df.select("*", *exprs)
    if add_zscore:
        out = out.select("*", *[zscore(F.col(s), F.col(f"{s}_roll_mean"), F.col(f"{s}_roll_std"))
                                .alias(f"{s}_zscore") for s in sensors])
    return out


def ts_features(df: DataFrame, spec: TelemetrySpec, window: int = ROLLING_WINDOW,
                add_diff: bool = True, add_zscore: bool = True, **plan_kw) -> DataFrame:
    """Rolling mean/std, first difference and local z-score for every sensor."""
    return apply_series(df, spec.asset, spec.order, window - 1, 0,
                        lambda d, lay: feature_steps(d, lay, spec.sensors, window, add_diff, add_zscore),
                        **plan_kw)


def rolling_only(df: DataFrame, spec: TelemetrySpec, window: int = ROLLING_WINDOW, std: bool = False,
                 **plan_kw) -> DataFrame:
    """Only the rolling mean (or std) columns — the single-operator form of W3/W4."""
    def build(d, lay):
        w = lay.window()
        fn = rolling_std if std else rolling_mean
        suffix = "_roll_std" if std else "_roll_mean"
        return d.select("*", *[fn(s, w, window).alias(f"{s}{suffix}") for s in spec.sensors if s in d.columns])
    return apply_series(df, spec.asset, spec.order, window - 1, 0, build, **plan_kw)


def diff_only(df: DataFrame, spec: TelemetrySpec, **plan_kw) -> DataFrame:
    def build(d, lay):
        w = lay.window()
        return d.select("*", *[first_diff(s, w).alias(f"{s}_diff") for s in spec.sensors if s in d.columns])
    return apply_series(df, spec.asset, spec.order, 1, 0, build, **plan_kw)


TIE = "_vg_tie"


def total_order(df: DataFrame, spec: TelemetrySpec) -> tuple[DataFrame, TelemetrySpec]:
    """``df`` and ``spec`` with a tiebreak: a hash of the row's input values where the spec names none.

    Two rows of one asset at one time then come in the same order under any partitioning, chunked or not. Rows that are equal in
    every sensor, context and id column stay interchangeable. Labels are not read.
    """
    if spec.tiebreak:
        return df, spec
    cols = [c for c in (*spec.fill_columns, spec.regime, *spec.ids) if c and c in df.columns]
    return df.withColumn(TIE, F.xxhash64(*cols) if cols else F.lit(0).cast("long")), spec.with_(tiebreak=(TIE,))


def wrangle_and_features(df: DataFrame, spec: TelemetrySpec, window: int = ROLLING_WINDOW,
                         limit: int = FILL_LIMIT, causal: bool = False, add_diff: bool = True,
                         add_zscore: bool = True, **plan_kw) -> DataFrame:
    """Wrangle + features in one pass: one shuffle by asset (or by asset chunk) for both.

    A feature at row t reads raw rows [t - (window-1) - limit, t + limit], which is the
    halo a chunked layout carries.
    """
    back, ahead = halo(limit, causal)
    cols = [c for c in spec.fill_columns if c in df.columns]

    def build(d, lay):
        filled = wrangle_steps(d, lay, cols, limit, causal)
        return feature_steps(filled, lay, spec.sensors, window, add_diff, add_zscore)

    return apply_series(df, spec.asset, spec.order, back + window - 1, ahead, build, **plan_kw)


def select_features(columns: Sequence[str], spec: TelemetrySpec, include_context: bool = True,
                    add_diff: bool = True, add_zscore: bool = True,
                    include_missing_flags: bool = False) -> list[str]:
    """Ordered modelling features: sensors, generated columns, then numeric context.

    Selection is by generated name, never by suffix, so an input column that merely ends in
    ``_diff`` cannot sneak in; labels, ids, timestamp and regime are never selected.
    """
    present = set(columns)
    names = list(spec.sensors) + derived_names(spec.sensors, add_diff, add_zscore)
    if include_context:
        names += list(spec.context)
    if include_missing_flags:
        names += [f"{c}_was_nan" for c in spec.fill_columns]
    chosen = [c for c in names if c in present]
    label_guard(chosen, spec)
    return chosen


def label_guard(features: Sequence[str], spec: TelemetrySpec) -> None:
    """Fail if any label, id, key, timestamp or regime column would enter the model."""
    forbidden = {spec.ts, spec.asset, *spec.tiebreak, *spec.label_columns, *spec.ids}
    if spec.regime:
        forbidden.add(spec.regime)
    bad = sorted(set(features) & forbidden)
    if bad:
        raise ValueError(f"non-feature columns in the feature list: {bad}")


def smoothed_diff(df: DataFrame, spec: TelemetrySpec, window: int = ROLLING_WINDOW, **plan_kw) -> DataFrame:
    """Rolling mean of the first difference (docs extension)."""
    def build(d, lay):
        w = lay.window()
        sensors = [s for s in spec.sensors if s in d.columns]
        tmp = d.select("*", *[first_diff(s, w).alias(f"_d_{s}") for s in sensors])
        return tmp.select(*d.columns, *[rolling_mean(f"_d_{s}", w, window).alias(f"{s}_diff_smooth")
                                        for s in sensors])
    return apply_series(df, spec.asset, spec.order, window, 0, build, **plan_kw)


def lag_features(df: DataFrame, spec: TelemetrySpec, lags: Sequence[int] = (1, 5, 15), **plan_kw) -> DataFrame:
    """Sensor values ``k`` rows back (null before the series has k rows)."""
    def build(d, lay):
        w = lay.window()
        return d.select("*", *[lag_value(s, w, k).alias(f"{s}_lag{k}")
                               for s in spec.sensors if s in d.columns for k in lags])
    return apply_series(df, spec.asset, spec.order, max(lags), 0, build, **plan_kw)


def rolling_cross_corr(df: DataFrame, spec: TelemetrySpec, pairs: Sequence[tuple[str, str]],
                       window: int = ROLLING_WINDOW, **plan_kw) -> DataFrame:
    """Pearson correlation of sensor pairs over the last ``window`` rows; null when constant."""
    def build(d, lay):
        frame = lay.window().rowsBetween(-(window - 1), 0)
        out = []
        for a, b in pairs:
            const = ((F.max(a).over(frame) == F.min(a).over(frame))
                     | (F.max(b).over(frame) == F.min(b).over(frame)))
            # covar / (std · std) with try_divide: ANSI mode would raise inside ``corr`` on
            # constant frames before the guard could mask them
            r = F.try_divide(F.covar_pop(a, b).over(frame),
                             F.stddev_pop(a).over(frame) * F.stddev_pop(b).over(frame))
            out.append(F.when(~const, r).alias(f"corr_{a}_{b}"))
        return d.select("*", *out)
    return apply_series(df, spec.asset, spec.order, window - 1, 0, build, **plan_kw)
