"""The two jobs: train (fit scaler, clusterer, threshold; evaluate; persist) and score
(``detect_anomalies`` with a persisted model).

Physical shape of the train job: one shuffle for wrangle + features (per asset, or per
asset chunk when a series is hot), a checkpoint of the feature table, then only
aggregates over it (scaler, clustering steps, threshold, metrics). The score job is the
same feature pass followed by literal arithmetic — no second shuffle.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.config import DEFAULT_CONFIG, PipelineConfig, TelemetrySpec
from vigil.operators import cluster as cl
from vigil.operators.evaluate import evaluate
from vigil.operators.features import TIE, select_features, total_order, wrangle_and_features
from vigil.operators.scale import Projection, Scaler, fit_pca, fit_scaler
from vigil.operators.score import (PRED, SCORE, CentroidModel, MixtureModel, add_score, fit_threshold,
                                   threshold_predict)
from vigil.operators.split import SPLIT, cutoff_of, with_split
from vigil.plans.layout import join_small
from vigil.session import checkpointed


@dataclass(frozen=True)
class DetectorModel:
    spec: TelemetrySpec
    config: PipelineConfig
    features: tuple[str, ...]
    scaler: Scaler
    projection: Projection | None
    clusterer: CentroidModel | MixtureModel
    threshold: float
    percentile: float

    def model_space(self, feats: DataFrame) -> DataFrame:
        """Scaled (and projected) model columns added to a feature table."""
        out = self.scaler.transform(feats)
        if self.projection is not None:
            out = out.select("*", *self.projection.exprs())
        return out


def featurize(df: DataFrame, spec: TelemetrySpec, config: PipelineConfig = DEFAULT_CONFIG, **plan_kw) -> DataFrame:
    plan_kw.setdefault("max_series_rows", config.max_series_rows)
    plan_kw.setdefault("chunk_rows", config.chunk_rows)
    return wrangle_and_features(df, spec, window=config.rolling_window, limit=config.fill_limit,
                                causal=config.causal_fill, add_diff=config.add_diff,
                                add_zscore=config.add_zscore, **plan_kw)


def detect_anomalies(df: DataFrame, model: DetectorModel, return_only_anomalies: bool = False,
                     **plan_kw) -> DataFrame:
    """Input columns unchanged (fills are internal) plus ``anomaly_score`` and ``anomaly_pred``.
    Labels, if present, are carried but never read."""
    ordered, spec = total_order(df, model.spec)
    fill = [c for c in spec.fill_columns if c in df.columns]
    keep = ordered.select("*", *[F.col(c).alias(f"_o_{c}") for c in fill])
    feats = featurize(keep, spec, model.config, **plan_kw)
    scored = threshold_predict(add_score(model.model_space(feats), model.clusterer), model.threshold)
    out = scored.select(*[F.col(f"_o_{c}").alias(c) if c in fill else F.col(c) for c in df.columns], SCORE, PRED)
    return out.filter(F.col(PRED) == 1) if return_only_anomalies else out


@dataclass
class TrainReport:
    model: DetectorModel
    cutoff: dt.datetime
    best_k: int
    k_results: list = field(default_factory=list)
    inertia: float | None = None
    silhouette: float | None = None
    scored: DataFrame | None = None
    metrics: DataFrame | None = None


def train(df: DataFrame, spec: TelemetrySpec, config: PipelineConfig = DEFAULT_CONFIG, quick: bool = False,
          key: str | None = None, out_dir: str | None = None, expect: dict | None = None,
          **plan_kw) -> TrainReport:
    """Fit the detector on rows before ``min(ts) + train_days`` and evaluate both splits.

    K precedence: ``config.kmeans_n_clusters`` > ``quick`` (``k_default``) > silhouette search.
    ``expect`` checks the input contract (rows / columns / assets) first and raises on a mismatch.
    ``key`` names a unique row key (sampling, lowest-key init); by default the
    ``(asset, ts, tiebreak...)`` struct. Without a tiebreak in ``spec`` a hash of the input values is one.
    ``config.model``: ``kmeans`` (MLlib k-means||, best of n_init), ``minibatch``, ``gmm``,
    or ``lloyd`` (Lloyd steps from the K lowest-``key`` train rows; deterministic).
    """
    if expect is not None:     # e.g. {"rows": 230_400, "cols": 19, "assets": 16}
        from vigil.operators.profile import assert_contract, input_contract
        assert_contract(input_contract(df, spec, expect.get("rows"), expect.get("cols"), expect.get("assets")))
    cut = cutoff_of(df, spec, config.train_days)
    rows, ordered = total_order(df, spec)
    feats = with_split(featurize(rows, ordered, config, **plan_kw), spec, cut)
    if key is None:            # unique row key by the total-order contract: (asset, ts, tiebreak...)
        key = "_vg_key"
        feats = feats.withColumn(key, F.struct(spec.asset, *ordered.order))
    feats = checkpointed(feats.drop(TIE))
    cols = select_features(feats.columns, spec, config.include_context, config.add_diff, config.add_zscore,
                           config.include_missing_flags)
    is_train = F.col(SPLIT) == "train"
    scaler = fit_scaler(feats.filter(is_train), cols)
    space = scaler.transform(feats)
    projection = None
    mcols = list(cols)
    if config.use_pca:
        projection = fit_pca(space.filter(is_train), cols, config.pca_n_components)
        space = space.select("*", *projection.exprs())
        mcols = projection.output_columns
    # A projection of the one feature copy; only the step-by-step Lloyd reads a copy of its own.
    pts = space.filter(is_train).select(key, *mcols)
    if config.model == "lloyd":
        pts = checkpointed(pts)

    fit = _fitter(config, key, cl.fit_input(pts, mcols) if config.model in ("kmeans", "gmm") else None,
                  cl.minibatch_slices(pts, mcols, config.random_state) if config.model == "minibatch" else None)
    k_results = []
    if config.kmeans_n_clusters is not None:
        best_k = config.kmeans_n_clusters
    elif quick:
        best_k = config.k_default
    else:
        best_k, k_results = cl.select_k(pts, mcols, key, config.k_range, fit=fit,
                                        sample_size=config.silhouette_sample, seed=config.random_state,
                                        is_stable=True)
    chosen = next((r for r in k_results if r.k == best_k), None)
    if chosen is not None:      # same seed and partitioning: a refit would return this model
        clusterer, cost = chosen.model, chosen.inertia
    else:
        clusterer, cost = fit(pts, mcols, best_k)
    if chosen is not None:
        sil = chosen.silhouette
    else:
        X = cl.sample_points(pts, mcols, key, config.silhouette_sample, config.random_state)
        sil = cl.silhouette_scores(df.sparkSession, X, {best_k: cl.assign_np(X, clusterer)})[best_k] if len(X) else None

    scored = add_score(space, clusterer, cluster_col="cluster")
    threshold = fit_threshold(scored.filter(is_train), config.threshold_percentile,
                              approx=not config.exact_percentile)
    scored = threshold_predict(scored, threshold)
    model = DetectorModel(spec, config, tuple(cols), scaler, projection, clusterer, threshold,
                          config.threshold_percentile)
    metrics = None
    if spec.label and spec.label in df.columns:
        metrics = evaluate(scored, spec.label, PRED, SCORE, spec.fault if spec.fault in df.columns else None,
                           keys=[SPLIT])
    report = TrainReport(model, cut, best_k, k_results, cost if isinstance(clusterer, CentroidModel) else None,
                         sil, scored, metrics)
    if out_dir:
        from vigil.sources.store import save_model, write_metrics
        spark = df.sparkSession
        save_model(spark, model, f"{out_dir}/model")
        # One row per split, with or without labels: its rows, flags, and the run's parameters.
        counts = scored.filter(F.col(SPLIT).isNotNull()).groupBy(SPLIT).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(PRED)).cast("long").alias("n_flagged"))
        run = counts.select(
            F.lit(best_k).alias("best_k"), F.lit(sil).cast("double").alias("silhouette"),
            F.lit(report.inertia).cast("double").alias("inertia"), F.lit(threshold).alias("threshold"),
            F.lit(config.threshold_percentile).alias("threshold_percentile"),
            F.lit(str(cut)).alias("cutoff"), "n_rows", "n_flagged", SPLIT)
        if metrics is not None:
            run = join_small(run, metrics, SPLIT, 3, "left")
        write_metrics(run, f"{out_dir}/metrics")
    return report


def _fitter(config: PipelineConfig, key: str, vec: DataFrame | None = None, slices: cl.Slices | None = None):
    """Fit function (train rows, columns, K) → (model, cost); ``vec`` = shared MLlib input, ``slices`` = shared
    mini-batch slices: one copy of the features, whatever the number of K."""
    seed = config.random_state
    if config.model == "kmeans":
        return lambda d, c, k: cl.fit_kmeans(d, c, k, seed=seed, max_iter=config.kmeans_max_iter,
                                             n_init=config.kmeans_n_init, vec=vec)
    if config.model == "minibatch":
        return lambda d, c, k: cl.fit_minibatch_kmeans(d, c, k, seed=seed, slices=slices)
    if config.model == "gmm":
        return lambda d, c, k: cl.fit_gmm(d, c, k, seed=seed, max_iter=config.gmm_max_iter,
                                          n_init=config.gmm_n_init, vec=vec, is_stable=True)
    if config.model == "lloyd":
        steps = int(config.extra.get("lloyd_steps", 5))

        def lloyd(d, c, k):
            init = cl.lowest_key_centres(d, c, key, k)
            m, costs = cl.kmeans_fixed_init(d, c, init, steps, checkpoint=False)
            return m, cl.inertia(d, m)
        return lloyd
    raise ValueError(f"unknown model {config.model!r}")
