"""Registered queries: one Spark DataFrame builder per operator key, over the driver tables.

Every builder takes (spark, sf_dir) and reads the parquet tables (or fixtures Spark derives
from them), so its work grows with the data. Doubles are rounded to 6 places and integer
types fixed so that results compare cell for cell with the DuckDB twins in
``vigil.sql_twins``.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from vigil.config import EVENTS_SPEC, EXPECTED_ASSETS, EXPECTED_COLS, EXPECTED_ROWS, LINEITEM_SPEC
from vigil.operators import drift as dr
from vigil.operators import evaluate as ev
from vigil.operators import features as fe
from vigil.operators import profile as pr
from vigil.operators import wrangle as wr
from vigil.config import REFERENCE_SPEC, PipelineConfig
from vigil.functions.vector import nearest
from vigil.operators.cluster import (concurrently, davies_bouldin, elbow_table, em_points, fit_gmm, fit_gmms, fit_input, fit_kmeans, fit_minibatch_kmeans,
                                     gmm_information, hash_sample, kmeans_fixed_init, lowest_key_centres,
                                     select_k, silhouette, stable)
from vigil.operators.mixture import gmm_fixed_init
from vigil.operators.scale import fit_pca, fit_scaler, pca_fixed_steps
from vigil.operators.score import (CentroidModel, MixtureModel, add_score, assign_cluster, fit_threshold, grouped_threshold, only_anomalies,
                                   predict_grouped, score_summary, threshold_3sigma, threshold_predict)
from vigil.operators.walkforward import temporal_cv_metrics
from vigil.operators.split import SPLIT, cutoff_of, split_summary, temporal_folds, ts_lit, with_split
from vigil.plans.order_stats import grouped_percentiles, percentiles
from vigil.plans import jobs, sketches
from vigil.plans.incremental import open_rows, read_state, score_period
from vigil.sources import fixtures as fx
from vigil.sources.store import load_model, version_path, write_scored
from vigil.sources.telemetry import read_telemetry, read_with_rejects, write_telemetry_csv
from vigil.streaming import replay, stream_anomaly_rate, stream_score
from vigil.streaming.kmeans import read_centres, stream_kmeans
from vigil.streaming.stateful import rocksdb, stream_score_stateful

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

EV = EVENTS_SPEC
LI = LINEITEM_SPEC
EV_TRAIN_DAYS = 21      # 70/30 split of the events fixture (as the reference's 7 of 10 days)
EXPECTED_SAMPLES_PER_ASSET = 14_400   # reference contract: 10 days of 1-minute samples


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places and normalise -0.0."""
    return df.select(*[(F.round(F.col(f.name), 6) + F.lit(0.0)).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


# ---------------------------------------------------------------------------
# Flagship: wrangle → features → split → standardise → Lloyd from the K lowest-id train
# rows → nearest-centre distance → p99 threshold on train → prediction.
# ---------------------------------------------------------------------------

def events_model_input(spark: SparkSession, sf: str):
    """Feature table of F1 with its split column, checkpointed once for all later passes."""
    f1 = fx.telemetry_events(spark, sf)
    cut = cutoff_of(f1, EV, EV_TRAIN_DAYS)
    feats = with_split(fe.wrangle_and_features(f1, EV), EV, cut)
    cols = fe.select_features(feats.columns, EV)
    return stable(feats), cols


def events_scored(spark: SparkSession, sf: str, k: int = 3, steps: int = 5, p: float = 99.0) -> DataFrame:
    """F1 rows with cluster, anomaly_score and anomaly_pred under the flagship model."""
    feats, cols = events_model_input(spark, sf)
    is_train = F.col(SPLIT) == "train"
    scaler = fit_scaler(feats.filter(is_train), cols)
    scaled = scaler.transform(feats)
    train = scaled.filter(is_train).select("event_id", *cols)
    init = lowest_key_centres(train, cols, "event_id", k)
    model, _ = kmeans_fixed_init(train, cols, init, steps)
    scored = add_score(scaled, model, cluster_col="cluster")
    thr = fit_threshold(scored.filter(is_train), p)
    return threshold_predict(scored, thr)


@query("detect_anomalies")
def flagship(spark: SparkSession, sf: str, k: int = 3, steps: int = 5, p: float = 99.0) -> DataFrame:
    out = events_scored(spark, sf, k, steps, p)
    return r6(out.select("event_id", "asset_id", "timestamp", SPLIT, "anomaly_score", "anomaly_pred"))


# ---------------------------------------------------------------------------
# Sources and fixtures
# ---------------------------------------------------------------------------

@query("telemetry_source")
def q_telemetry_source(spark, sf):
    return r6(fx.telemetry_events(spark, sf))


@query("telemetry_lineitem")
def q_telemetry_lineitem(spark, sf):
    return r6(fx.telemetry_lineitem(spark, sf))


# ---------------------------------------------------------------------------
# Wrangling
# ---------------------------------------------------------------------------

@query("missing_flags")
def q_missing_flags(spark, sf):
    f1 = fx.telemetry_events(spark, sf)
    return r6(wr.missing_flags(f1, EV.fill_columns))


@query("ffill_limited")
def q_ffill(spark, sf):
    return r6(wr.ffill_limited(fx.telemetry_events(spark, sf), EV))


@query("bfill_limited")
def q_bfill(spark, sf):
    return r6(wr.bfill_limited(fx.telemetry_events(spark, sf), EV))


@query("zero_sentinel")
def q_zero(spark, sf):
    return r6(wr.zero_sentinel(fx.telemetry_events(spark, sf), EV.fill_columns))


@query("wrangle")
def q_wrangle(spark, sf):
    return r6(wr.wrangle(fx.telemetry_events(spark, sf), EV))


@query("wrangle_lineitem")
def q_wrangle_li(spark, sf):
    return r6(wr.wrangle(fx.telemetry_lineitem(spark, sf), LI))


@query("residual_missing")
def q_residual(spark, sf):
    return wr.residual_missing(fx.telemetry_events(spark, sf), EV)


# ---------------------------------------------------------------------------
# Features (W3–W7)
# ---------------------------------------------------------------------------

@query("rolling_mean")
def q_rolling_mean(spark, sf):
    return r6(fe.rolling_only(wr.wrangle(fx.telemetry_events(spark, sf), EV), EV))


@query("rolling_std")
def q_rolling_std(spark, sf):
    return r6(fe.rolling_only(wr.wrangle(fx.telemetry_events(spark, sf), EV), EV, std=True))


@query("first_diff")
def q_first_diff(spark, sf):
    return r6(fe.diff_only(wr.wrangle(fx.telemetry_events(spark, sf), EV), EV))


@query("ts_features")
def q_ts_features(spark, sf):
    return r6(fe.wrangle_and_features(fx.telemetry_events(spark, sf), EV))


@query("ts_features_lineitem")
def q_ts_features_li(spark, sf):
    return r6(fe.wrangle_and_features(fx.telemetry_lineitem(spark, sf), LI))


# ---------------------------------------------------------------------------
# Split, projections, predicates
# ---------------------------------------------------------------------------

def events_split(spark, sf):
    f1 = fx.telemetry_events(spark, sf)
    return with_split(f1, EV, cutoff_of(f1, EV, EV_TRAIN_DAYS))


@query("time_split")
def q_time_split(spark, sf):
    return r6(events_split(spark, sf))


@query("split_summary")
def q_split_summary(spark, sf):
    f1 = fx.telemetry_events(spark, sf)
    return split_summary(f1, EV, cutoff_of(f1, EV, EV_TRAIN_DAYS))


@query("select_features")
def q_select_features(spark, sf):
    feats = fe.wrangle_and_features(fx.telemetry_events(spark, sf), EV)
    return r6(feats.select("event_id", *fe.select_features(feats.columns, EV)))


def eval_input(spark, sf, rounded: bool = True) -> DataFrame:
    """F4 (score = rounded s1, pred = s1 >= 150) plus regime and the 21-day split."""
    f1 = events_split(spark, sf)
    s = F.coalesce(F.col("s1"), F.lit(0.0))
    return f1.select("event_id", "asset_id", "timestamp", "regime", SPLIT,
                     (F.round(s, 0) if rounded else s).alias("anomaly_score"),
                     "anomaly_label", "fault_code_true",
                     F.when(s >= 150, 1).otherwise(0).alias("anomaly_pred"))


@query("threshold_predict")
def q_threshold_predict(spark, sf):
    df = eval_input(spark, sf, rounded=False)
    thr = fit_threshold(df, 99.0)
    return r6(threshold_predict(df, thr, pred_col="pred_p99").select("event_id", "anomaly_score", "pred_p99"))


@query("only_anomalies")
def q_only_anomalies(spark, sf):
    return r6(only_anomalies(eval_input(spark, sf)))


@query("asset_slice")
def q_asset_slice(spark, sf):
    f1 = fx.telemetry_events(spark, sf)
    first = f1.agg(F.min("asset_id").alias("a")).first()["a"]
    return r6(pr.asset_slice(f1, EV, first, label="anomaly_label"))


@query("asset_time_order")
def q_asset_time_order(spark, sf):
    return r6(pr.ordered(fx.telemetry_events(spark, sf), EV))


@query("preview")
def q_preview(spark, sf):
    return r6(pr.preview(fx.telemetry_events(spark, sf), EV, 20))


@query("seeded_sample")
def q_seeded_sample(spark, sf):
    return r6(pr.seeded_sample(fx.telemetry_events(spark, sf), "event_id", 100, seed=42))


@query("top_anomalies")
def q_top_anomalies(spark, sf):
    return r6(pr.top_anomalies(eval_input(spark, sf, rounded=False), 20))


# ---------------------------------------------------------------------------
# Profiling aggregates
# ---------------------------------------------------------------------------

@query("period_summary")
def q_period_summary(spark, sf):
    return pr.period_summary(fx.telemetry_events(spark, sf), EV)


@query("input_contract")
def q_input_contract(spark, sf):
    return pr.input_contract(fx.telemetry_events(spark, sf), EV, EXPECTED_ROWS, EXPECTED_COLS, EXPECTED_ASSETS)


@query("missing_profile")
def q_missing_profile(spark, sf):
    return r6(pr.missing_profile(fx.telemetry_events(spark, sf), EV.fill_columns))


@query("asset_coverage")
def q_asset_coverage(spark, sf):
    return r6(pr.asset_coverage(fx.telemetry_events(spark, sf), EV, expected=EXPECTED_SAMPLES_PER_ASSET))


@query("value_counts")
def q_value_counts(spark, sf):
    f1 = fx.telemetry_events(spark, sf)
    return pr.value_counts(f1, {"regime": F.col("regime"), "anomaly_label": F.col("anomaly_label"),
                                "fault": F.col("fault_code_true") != 0})


@query("prevalence")
def q_prevalence(spark, sf):
    return r6(pr.prevalence(events_split(spark, sf), "anomaly_label", "fault_code_true", keys=[SPLIT]))


@query("score_percentile")
def q_score_percentile(spark, sf):
    return r6(grouped_percentiles(eval_input(spark, sf), "anomaly_score", [0.5, 0.9, 0.99]))


@query("score_summary")
def q_score_summary(spark, sf):
    df = eval_input(spark, sf, rounded=False).filter(F.col(SPLIT) == "train")
    return r6(score_summary(df, fit_threshold(df, 99.0)))


@query("cluster_regime_crosstab")
def q_crosstab(spark, sf):
    return r6(pr.crosstab(events_scored(spark, sf), "cluster", "regime"))


@query("anomaly_map")
def q_anomaly_map(spark, sf):
    return pr.anomaly_map(events_scored(spark, sf), EV)


# ---------------------------------------------------------------------------
# Evaluation (E1–E9, M15) and thresholds
# ---------------------------------------------------------------------------

@query("confusion_matrix")
def q_confusion(spark, sf):
    return ev.confusion(eval_input(spark, sf))


@query("precision_recall_f1")
def q_prf(spark, sf):
    return r6(ev.precision_recall_f1(eval_input(spark, sf)))


@query("roc_auc")
def q_roc_auc(spark, sf):
    return r6(ev.rank_metrics(eval_input(spark, sf)).select("roc_auc"))


@query("average_precision")
def q_ap(spark, sf):
    return r6(ev.rank_metrics(eval_input(spark, sf)).select("pr_auc"))


@query("roc_auc_unrounded")
def q_roc_auc_raw(spark, sf):
    return r6(ev.rank_metrics(eval_input(spark, sf, rounded=False)))


@query("fault_recall")
def q_fault_recall(spark, sf):
    return r6(ev.fault_recall(eval_input(spark, sf)))


@query("pr_curve")
def q_pr_curve(spark, sf):
    return r6(ev.pr_curve(eval_input(spark, sf)))


@query("score_histogram")
def q_histogram(spark, sf):
    return r6(ev.score_histogram(eval_input(spark, sf), keys=[SPLIT]))


@query("evaluate")
def q_evaluate(spark, sf):
    return r6(ev.evaluate(eval_input(spark, sf)))


@query("metrics_by_split")
def q_metrics_by_split(spark, sf):
    return r6(ev.evaluate(eval_input(spark, sf), keys=[SPLIT]))


@query("metrics_by_regime")
def q_metrics_by_regime(spark, sf):
    return r6(ev.evaluate(eval_input(spark, sf), keys=["regime"]))


SWEEP = (90.0, 95.0, 97.5, 99.0, 99.5)


@query("threshold_sweep")
def q_threshold_sweep(spark, sf):
    df = eval_input(spark, sf, rounded=False)
    ts = percentiles(df, "anomaly_score", [p / 100 for p in SWEEP])
    return r6(ev.threshold_sweep(df, list(zip(SWEEP, ts))))


@query("threshold_3sigma")
def q_threshold_3sigma(spark, sf):
    df = eval_input(spark, sf, rounded=False)
    t = threshold_3sigma(df.filter(F.col(SPLIT) == "train"))
    flagged = threshold_predict(df, t, pred_col="pred")
    return r6(flagged.groupBy(SPLIT).agg(F.first(F.lit(t)).alias("threshold"),
                                         F.sum("pred").cast("long").alias("n_pred")))


@query("threshold_max_f1")
def q_threshold_max_f1(spark, sf):
    return r6(ev.best_threshold(eval_input(spark, sf, rounded=False), objective="f1"))


@query("threshold_min_cost")
def q_threshold_min_cost(spark, sf):
    return r6(ev.best_threshold(eval_input(spark, sf, rounded=False), objective="cost", c_fp=1.0, c_fn=10.0))


def _grouped_pred(df, keys):
    thr = grouped_threshold(df.filter(F.col(SPLIT) == "train"), keys, 99.0)
    out = predict_grouped(df, thr, keys, pred_col="pred_group")
    return r6(out.select("event_id", *keys, "threshold", "pred_group"))


@query("threshold_per_asset")
def q_threshold_per_asset(spark, sf):
    return _grouped_pred(eval_input(spark, sf, rounded=False), ["asset_id"])


@query("threshold_per_regime")
def q_threshold_per_regime(spark, sf):
    return _grouped_pred(eval_input(spark, sf, rounded=False), ["regime"])


@query("threshold_per_cluster")
def q_threshold_per_cluster(spark, sf):
    return _grouped_pred(events_scored(spark, sf), ["cluster"])


# ---------------------------------------------------------------------------
# Clustering (M2–M11, D7, D8) on the vectors fixture
# ---------------------------------------------------------------------------
VEC_K, VEC_STEPS = 4, 4


def vec_model(spark, sf):
    v = fx.vectors(spark, sf)
    cols = fx.vector_columns(v)
    init = lowest_key_centres(v, cols, "vec_id", VEC_K)
    model, costs = kmeans_fixed_init(v, cols, init, VEC_STEPS)
    return v, cols, model, costs


def _one_row(spark, values: dict, schema: str) -> DataFrame:
    return spark.createDataFrame([tuple(values.values())], schema)


@query("kmeans_fixed_init")
def q_kmeans_fixed_init(spark, sf):
    _, cols, model, _ = vec_model(spark, sf)
    rows = [(i, *c) for i, c in enumerate(model.centres)]
    return r6(spark.createDataFrame(rows, "cid int, " + ", ".join(f"{c} double" for c in cols)))


@query("assign_cluster")
def q_assign_cluster(spark, sf):
    v, _, model, _ = vec_model(spark, sf)
    return assign_cluster(v, model).select("vec_id", "cluster")


@query("nearest_centroid_score")
def q_nearest_centroid_score(spark, sf):
    v, _, model, _ = vec_model(spark, sf)
    return r6(add_score(v, model).select("vec_id", "anomaly_score"))


@query("inertia")
def q_inertia(spark, sf):
    v, _, model, _ = vec_model(spark, sf)
    d2 = nearest(model.columns, model.centres).getField("d2")
    return r6(v.agg(F.sum(d2).alias("inertia")))


@query("silhouette_sample")
def q_silhouette(spark, sf):
    v = fx.vectors(spark, sf)
    cols = fx.vector_columns(v)
    sample = hash_sample(v, "vec_id", PipelineConfig().silhouette_sample, 42)
    return r6(_one_row(spark, {"silhouette": silhouette(sample, cols, "label", "vec_id")}, "silhouette double"))


@query("silhouette_kmeans")
def q_silhouette_kmeans(spark, sf):
    v, cols, model, _ = vec_model(spark, sf)
    sample = assign_cluster(hash_sample(v, "vec_id", PipelineConfig().silhouette_sample, 42), model)
    return r6(_one_row(spark, {"silhouette": silhouette(sample, cols, "cluster", "vec_id")}, "silhouette double"))


@query("davies_bouldin")
def q_davies_bouldin(spark, sf):
    v, _, model, _ = vec_model(spark, sf)
    return r6(_one_row(spark, {"davies_bouldin": davies_bouldin(v, model)}, "davies_bouldin double"))


def label_mixture(v: DataFrame, cols, label: str = "label", ridge: float = 1e-6) -> MixtureModel:
    """Diagonal Gaussian per label group (weights = group shares): fixed-parameter mixture."""
    rows = (v.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"m_{c}") for c in cols],
                                 *[F.var_pop(c).alias(f"v_{c}") for c in cols]).orderBy(label).collect())
    n = sum(r["_n"] for r in rows)
    covs = tuple(tuple(tuple(float(r[f"v_{c}"]) if i == j else 0.0 for j, c in enumerate(cols))
                       for i in range(len(cols))) for r in rows)
    return MixtureModel(tuple(cols), tuple(r["_n"] / n for r in rows),
                        tuple(tuple(float(r[f"m_{c}"]) for c in cols) for r in rows), covs, ridge=ridge)


@query("gmm_score")
def q_gmm_score(spark, sf):
    v = fx.vectors(spark, sf)
    model = label_mixture(v, fx.vector_columns(v))
    return r6(add_score(v, model).select("vec_id", "anomaly_score"))


@query("gmm_score_batches")
def q_gmm_score_batches(spark, sf):
    """Same mixture, scored on Arrow batches (the path used when K·d² is too large for codegen)."""
    from vigil.operators.score import _score_batches
    v = fx.vectors(spark, sf)
    model = label_mixture(v, fx.vector_columns(v))
    return r6(_score_batches(v, model, "anomaly_score", None).select("vec_id", "anomaly_score"))


# Fitted models (MLlib / iterative): property-checked in tests, rows-only at the driver.

@query("kmeans")
def q_kmeans(spark, sf):
    v = fx.vectors(spark, sf)
    model, _ = fit_kmeans(v, fx.vector_columns(v), 4, seed=42, max_iter=500, n_init=10)
    return assign_cluster(v, model).select("vec_id", "cluster")


@query("minibatch_kmeans")
def q_minibatch(spark, sf):
    v = fx.vectors(spark, sf)
    model, _ = fit_minibatch_kmeans(v, fx.vector_columns(v), 4, seed=42, batch_size=256)
    return assign_cluster(v, model).select("vec_id", "cluster")


@query("gmm")
def q_gmm(spark, sf):
    v = fx.vectors(spark, sf)
    model, _ = fit_gmm(v, fx.vector_columns(v), 3, seed=42)
    return r6(add_score(v, model, cluster_col="cluster").select("vec_id", "cluster", "anomaly_score"))


GMM_DIMS, GMM_K, GMM_STEPS = 2, 3, 4


@query("gmm_fixed_init")
def q_gmm_fixed_init(spark, sf):
    """EM steps on two embedding components, from the lowest-id rows and unit covariances."""
    v = fx.vectors(spark, sf)
    cols = fx.vector_columns(v)[:GMM_DIMS]
    unit = tuple(tuple(float(i == j) for j in range(GMM_DIMS)) for i in range(GMM_DIMS))
    init = lowest_key_centres(v, cols, "vec_id", GMM_K)
    start = MixtureModel(tuple(cols), (1.0 / GMM_K,) * GMM_K, tuple(map(tuple, init)), (unit,) * GMM_K)
    model, history = gmm_fixed_init(stable(v.select(*cols)), start, GMM_STEPS)
    rows = [(k, model.weights[k], *model.means[k], *(model.covs[k][i][j] for i in range(GMM_DIMS) for j in range(i, GMM_DIMS)), history[-1])
            for k in range(GMM_K)]
    return r6(spark.createDataFrame(rows, "cid int, weight double, mean0 double, mean1 double, cov00 double, cov01 double, cov11 double, "
                                          "log_likelihood double"))


PCA_DIMS, PCA_STEPS = 4, 6


@query("pca_fixed_steps")
def q_pca_fixed_steps(spark, sf):
    """Subspace iteration on four embedding components, from the first two axes; loadings and explained shares."""
    v = fx.vectors(spark, sf)
    cols = fx.vector_columns(v)[:PCA_DIMS]
    proj = pca_fixed_steps(v, cols, [[1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]], PCA_STEPS)
    rows = [(j, *c, proj.explained_variance_ratio[j]) for j, c in enumerate(proj.components)]
    return r6(spark.createDataFrame(rows, "component int, " + ", ".join(f"{c} double" for c in cols) + ", explained double"))


@query("pca")
def q_pca(spark, sf):
    v = fx.vectors(spark, sf)
    proj = fit_pca(v, fx.vector_columns(v), 3)
    return r6(proj.transform(v, keep=["vec_id"]))


@query("elbow_table")
def q_elbow(spark, sf):
    v = fx.vectors(spark, sf)
    _, res = select_k(v, fx.vector_columns(v), "vec_id", PipelineConfig().k_range,
                      fit=lambda d, c, k: fit_kmeans(d, c, k, seed=42, n_init=1))
    return r6(elbow_table(spark, res))


@query("gmm_bic")
def q_gmm_bic(spark, sf):
    v = fx.vectors(spark, sf)
    cols = fx.vector_columns(v)
    rows = []
    points, ks = em_points(v, cols), PipelineConfig().k_range
    fits = fit_gmms(points, cols, ks, seed=42, vec=fit_input(v, cols), is_stable=True)
    for k, info in zip(ks, concurrently(lambda fit: gmm_information(points, fit[0]), fits)):
        rows.append((k, info["log_likelihood"], info["n_params"], info["bic"], info["aic"]))
    return r6(spark.createDataFrame(rows, "k int, log_likelihood double, n_params int, bic double, aic double"))


# ---------------------------------------------------------------------------
# Documented extensions (T3): drift, folds, extra features, imputation, votes
# ---------------------------------------------------------------------------

def events_filled_split(spark, sf):
    return wr.wrangle(events_split(spark, sf), EV)


@query("drift_ks")
def q_drift_ks(spark, sf):
    return r6(dr.drift_ks(events_filled_split(spark, sf), EV.fill_columns))


@query("drift_psi")
def q_drift_psi(spark, sf):
    return r6(dr.drift_psi(events_filled_split(spark, sf), EV.fill_columns))


@query("drift_anomaly_rate")
def q_drift_rate(spark, sf):
    return r6(dr.anomaly_rate(eval_input(spark, sf), "timestamp", keys=["asset_id"]))


@query("training_sanity")
def q_training_sanity(spark, sf):
    return r6(dr.training_sanity(eval_input(spark, sf).filter(F.col(SPLIT) == "train")))


@query("temporal_cv")
def q_temporal_cv(spark, sf):
    folds = temporal_folds(fx.telemetry_events(spark, sf), EV, first_train_days=14, fold_days=4, n_folds=3)
    return folds.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n_rows"), F.min("timestamp").alias("ts_min"),
                                             F.max("timestamp").alias("ts_max"))


@query("temporal_cv_metrics")
def q_temporal_cv_metrics(spark, sf):
    """Metrics of each walk-forward fold, with the fold's own scaler and threshold."""
    feats = stable(fe.wrangle_and_features(fx.telemetry_events(spark, sf), EV))
    return r6(temporal_cv_metrics(feats, EV, fe.select_features(feats.columns, EV), first_train_days=14, fold_days=4, n_folds=3))


@query("smoothed_diff")
def q_smoothed_diff(spark, sf):
    return r6(fe.smoothed_diff(wr.wrangle(fx.telemetry_events(spark, sf), EV), EV))


@query("lag_features")
def q_lag_features(spark, sf):
    return r6(fe.lag_features(wr.wrangle(fx.telemetry_events(spark, sf), EV), EV, lags=(1, 5, 15)))


CORR_PAIRS = (("s1", "s2"), ("s1", "s3"), ("s2", "s3"))


@query("rolling_cross_corr")
def q_rolling_cross_corr(spark, sf):
    return r6(fe.rolling_cross_corr(wr.wrangle(fx.telemetry_events(spark, sf), EV), EV, CORR_PAIRS))


@query("asset_median_impute")
def q_asset_median_impute(spark, sf):
    return r6(dr.asset_median_impute(fx.telemetry_events(spark, sf), "asset_id", ["s1", "s2"]))


@query("ensemble_vote")
def q_ensemble_vote(spark, sf):
    """k-means distance flag OR the flag of a mixture with one diagonal component per regime, both
    at the 99th percentile of their train scores."""
    _, cols = events_model_input(spark, sf)
    scored = stable(events_scored(spark, sf))        # read four times below
    mixture = label_mixture(scored.filter(F.col(SPLIT) == "train"), cols, "regime")
    both = add_score(scored, mixture, "mixture_score")
    cut = fit_threshold(both.filter(F.col(SPLIT) == "train"), 99.0, "mixture_score")
    both = threshold_predict(both, cut, "mixture_score", "pred_mixture")
    voted = dr.ensemble_vote(both, ["anomaly_pred", "pred_mixture"], rule="or", out="pred_vote")
    return r6(voted.select("event_id", "anomaly_pred", "mixture_score", "pred_mixture", "pred_vote"))


# ---------------------------------------------------------------------------
# Jobs, sources and sinks
# ---------------------------------------------------------------------------

def scratch_path(spark, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    import uuid
    from vigil.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


JOB_CONFIG = PipelineConfig(train_days=EV_TRAIN_DAYS, kmeans_n_clusters=3, model="lloyd", extra={"lloyd_steps": 5})


@query("detect_anomalies_job")
def q_detect_job(spark, sf):
    """Train job (Lloyd, K=3) → model saved → loaded → score job; equals the flagship."""
    f1 = fx.telemetry_events(spark, sf)
    out = scratch_path(spark, "model")
    jobs.train(f1, EV, JOB_CONFIG, key="event_id", out_dir=out)
    model = load_model(spark, f"{out}/model")
    scored = jobs.detect_anomalies(f1, model)
    return r6(with_split(scored, EV, cutoff_of(f1, EV, EV_TRAIN_DAYS)).select(
        "event_id", "asset_id", "timestamp", SPLIT, "anomaly_score", "anomaly_pred"))


@query("only_anomalies_job")
def q_only_anomalies_job(spark, sf):
    f1 = fx.telemetry_events(spark, sf)
    rep = jobs.train(f1, EV, JOB_CONFIG, key="event_id")
    return r6(jobs.detect_anomalies(f1, rep.model, return_only_anomalies=True).select(
        "event_id", "asset_id", "timestamp", "anomaly_score", "anomaly_pred"))


@query("train_pipeline")
def q_train_pipeline(spark, sf):
    """Quick train (MLlib k-means, K = 5) with metrics per split (rows-only check)."""
    f1 = fx.telemetry_events(spark, sf)
    cfg = PipelineConfig(train_days=EV_TRAIN_DAYS, kmeans_n_init=2, kmeans_max_iter=50)
    rep = jobs.train(f1, EV, cfg, quick=True, key="event_id")
    return r6(rep.metrics)


@query("metrics_sink")
def q_metrics_sink(spark, sf):
    """Metrics of the deterministic train job, written and read back. The silhouette of the sampled rows is held against its range only."""
    f1 = fx.telemetry_events(spark, sf)
    out = scratch_path(spark, "run")
    jobs.train(f1, EV, JOB_CONFIG, key="event_id", out_dir=out)
    ratios = ["precision", "recall", "f1", "roc_auc", "pr_auc", "fault_code_recall", "inertia", "threshold", "threshold_percentile"]
    counts = ["n_anomalies_predicted", "n_anomalies_true", "tn", "fp", "fn", "tp", "best_k", "n_rows", "n_flagged"]
    sink = spark.read.json(f"{out}/metrics")
    return r6(sink.select("split", F.col("cutoff").cast("timestamp_ntz").alias("cutoff"), *[F.col(c).cast("double").alias(c) for c in ratios],
                          *[F.col(c).cast("long").alias(c) for c in counts], F.col("silhouette").between(-1.0, 1.0).alias("silhouette_in_range")))


@query("scored_tables")
def q_scored_tables(spark, sf):
    """Scored rows written partitioned by (split, date) and read back."""
    f1 = fx.telemetry_events(spark, sf)
    rep = jobs.train(f1, EV, JOB_CONFIG, key="event_id")
    out = scratch_path(spark, "scored")
    write_scored(rep.scored.select("event_id", "asset_id", "timestamp", SPLIT, "anomaly_score", "anomaly_pred"),
                 out, "timestamp")
    back = spark.read.parquet(out)
    return r6(back.select("event_id", "asset_id", "timestamp", SPLIT, "anomaly_score", "anomaly_pred"))


@query("scored_tables_incremental")
def q_scored_tables_incremental(spark, sf):
    """Scored rows written day group by day group, one of them twice; every other day stays."""
    f1 = fx.telemetry_events(spark, sf)
    rep = jobs.train(f1, EV, JOB_CONFIG, key="event_id")
    rows = stable(rep.scored.select("event_id", "asset_id", "timestamp", SPLIT, "anomaly_score", "anomaly_pred"))
    out = scratch_path(spark, "scored")
    for part in (0, 1, 2, 1):
        write_scored(rows.filter(F.dayofyear("timestamp") % 3 == part), out, "timestamp")
    return r6(spark.read.parquet(out).select("event_id", "asset_id", "timestamp", SPLIT, "anomaly_score", "anomaly_pred"))


@query("detect_anomalies_incremental")
def q_detect_incremental(spark, sf):
    """F1 scored week by week from the tail-state table; equals the job over the whole table."""
    src, state, out = (scratch_path(spark, n) for n in ("periods", "tail-state", "scored-runs"))
    week = F.date_format(F.date_trunc("week", "timestamp"), "'w'yyyyMMdd")
    fx.telemetry_events(spark, sf).withColumn("week", week).write.partitionBy("week").parquet(src)
    table = spark.read.parquet(src)
    f1 = table.drop("week")  # derived once: training reads the written periods, too
    model = jobs.train(f1, EV, JOB_CONFIG, key="event_id").model
    for r in sorted(table.select("week").distinct().collect()):
        score_period(table, "week", r["week"], model, state, out)
    done = spark.read.parquet(out).select(*f1.columns, "anomaly_score", "anomaly_pred")
    scored = done.unionByName(open_rows(spark, model, state))
    return r6(with_split(scored, EV, cutoff_of(f1, EV, EV_TRAIN_DAYS)).select(
        "event_id", "asset_id", "timestamp", SPLIT, "anomaly_score", "anomaly_pred"))


@query("threshold_sketch")
def q_threshold_sketch(spark, sf):
    """p99 from daily sketches, over all days, the last ten, and by asset: rows behind each, and whether every threshold's rank
    in the scores lies within the sketches' bound."""
    scored = stable(events_scored(spark, sf).select("asset_id", "timestamp", "anomaly_score"))
    path = scratch_path(spark, "sketches")
    sketches.write_sketches(scored, path, "timestamp", ["asset_id"])
    last = scored.agg(F.max(F.to_date(F.col("timestamp").cast("timestamp")))).first()[0]
    first = last - dt.timedelta(days=9)
    day = F.to_date(F.col("timestamp").cast("timestamp"))
    out = None
    for scope, keys, rows, since in (("all", [], scored, None), ("last_ten_days", [], scored.filter(day >= F.lit(first)), str(first)),
                                     ("by_asset", ["asset_id"], scored, None)):
        t = sketches.sketch_thresholds(spark, path, 99.0, keys, since, str(last))
        below, upto = (F.avg(c.cast("double")) for c in (F.col("anomaly_score") < F.col("threshold"), F.col("anomaly_score") <= F.col("threshold")))
        joined = rows.join(t.drop("n"), keys) if keys else rows.withColumn("threshold", F.lit(t.first()["threshold"]))
        ranks = joined.groupBy(*keys).agg(below.alias("lo"), upto.alias("hi"), F.count(F.lit(1)).alias("rows"))
        error = 2 * sketches.rank_error()  # a bound that no run exceeds but by rare chance
        one = ranks.agg(F.count(F.lit(1)).alias("n_groups"), F.sum("rows").alias("n_rows"),
                        F.bool_and((F.col("lo") - error <= 0.99) & (F.col("hi") + error >= 0.99)).alias("within_bound"))
        one = one.select(F.lit(scope).alias("scope"), "n_groups", "n_rows", "within_bound")
        out = one if out is None else out.unionByName(one)
    return out


@query("telemetry_csv")
def q_telemetry_csv(spark, sf):
    """F1 written as CSV and read back through the typed telemetry reader (by column name)."""
    f1 = fx.telemetry_events(spark, sf)
    out = scratch_path(spark, "csv")
    write_telemetry_csv(f1.select(*reversed(f1.columns)), out)   # any column order
    back = read_telemetry(spark, out, "csv", schema=f1.schema)
    return r6(back)


@query("telemetry_rejects")
def q_telemetry_rejects(spark, sf):
    """F1 written as CSV with some unreadable cells: the rejected rows and their columns, and the rows that are kept."""
    f1 = fx.telemetry_events(spark, sf)
    cells = f1.select(*[F.col(c).cast("string").alias(c) for c in f1.columns])
    id_ = F.col("event_id").cast("long")
    damaged = (cells.withColumn("s1", F.when(id_ % 97 == 0, "n/a?").otherwise(F.col("s1")))
               .withColumn("timestamp", F.when(id_ % 101 == 0, "yesterday").otherwise(F.col("timestamp")))
               .withColumn("s2", F.when(id_ % 53 == 0, "NaN").otherwise(F.col("s2"))))
    out = scratch_path(spark, "dirty-csv")
    damaged.write.option("header", True).csv(out)
    good, rejects = read_with_rejects(spark, out, f1.schema, max_share=0.05)
    bad = rejects.select(F.get_json_object("record", "$.event_id").cast("long").alias("event_id"), F.concat_ws(",", F.array_sort("columns")).alias("columns"))
    kept = good.select("event_id", F.lit("").alias("columns"))
    return bad.unionByName(kept)


# ---------------------------------------------------------------------------
# Structured Streaming (ST1, ST2)
# ---------------------------------------------------------------------------

@query("stream_score")
def q_stream_score(spark, sf):
    """Causal model trained in batch; F1 replayed as a stream in 3 event-time slices."""
    f1 = fx.telemetry_events(spark, sf)
    rep = jobs.train(f1, EV, JOB_CONFIG.with_(causal_fill=True), key="event_id")
    src, sink = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-out")
    f1.limit(0).write.parquet(src)
    stream = spark.readStream.schema(f1.schema).parquet(src)
    scored = stream_score(stream, rep.model, out_columns=["event_id", "asset_id", "timestamp"])
    q = (scored.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", sink + "-ckpt").outputMode("append").start())
    try:
        replay(spark, f1, "timestamp", 3, src, q.processAllAvailable)
    finally:
        q.stop()
    out = with_split(spark.read.parquet(sink), EV, rep.cutoff)
    return r6(out.select("event_id", "asset_id", "timestamp", SPLIT, "anomaly_score", "anomaly_pred"))


@query("stream_score_stateful")
def q_stream_score_stateful(spark, sf):
    """F1 scored on the state API: the first ten days in batch, their tail as the initial state, the rest as a stream."""
    f1 = fx.telemetry_events(spark, sf)
    rep = jobs.train(f1, EV, JOB_CONFIG.with_(causal_fill=True), key="event_id")
    cut = ts_lit(f1, "timestamp", cutoff_of(f1, EV, 10))
    before, after = f1.filter(F.col("timestamp") < cut), f1.filter(F.col("timestamp") >= cut)
    state, out = scratch_path(spark, "tail-state"), scratch_path(spark, "scored-runs")
    first = score_period(before.withColumn("part", F.lit("first")), "part", "first", rep.model, state, out)
    tail = read_state(spark, state).select(*f1.columns)
    src, sink = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-out")
    f1.limit(0).write.parquet(src)
    keep = ["event_id", "asset_id", "timestamp"]
    with rocksdb(spark):
        scored = stream_score_stateful(spark.readStream.schema(f1.schema).parquet(src), rep.model, keep, initial=tail)
        q = (scored.writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", sink + "-ckpt").outputMode("append").start())
    try:
        replay(spark, after, "timestamp", 2, src, q.processAllAvailable)
    finally:
        q.stop()
    rows = first.select(*keep, "anomaly_score", "anomaly_pred").unionByName(spark.read.parquet(sink))
    return r6(with_split(rows, EV, rep.cutoff).select("event_id", "asset_id", "timestamp", SPLIT, "anomaly_score", "anomaly_pred"))


@query("stream_kmeans")
def q_stream_kmeans(spark, sf):
    """Online k-means over the embeddings in three micro-batches, from the lowest-id rows."""
    v = fx.vectors(spark, sf)
    cols = fx.vector_columns(v)
    start = CentroidModel(tuple(cols), tuple(map(tuple, lowest_key_centres(v, cols, "vec_id", VEC_K))))
    src, state = scratch_path(spark, "kmeans-src"), scratch_path(spark, "kmeans-state")
    v.limit(0).write.parquet(src)
    q = stream_kmeans(spark.readStream.schema(v.schema).parquet(src), start, state, state + "-ckpt")
    try:
        for part in range(3):
            v.filter(F.col("vec_id") % 3 == part).write.mode("append").parquet(src)
            q.processAllAvailable()
    finally:
        q.stop()
    model, seen = read_centres(spark, state, cols)
    return r6(spark.createDataFrame([(i, n, *c) for i, (n, c) in enumerate(zip(seen, model.centres))],
                                    "cid int, n long, " + ", ".join(f"{c} double" for c in cols)))


@query("stream_anomaly_rate")
def q_stream_anomaly_rate(spark, sf):
    """Hourly anomaly rate per asset over the evaluation rows replayed as a stream. A window is
    written once, when the watermark has passed it; a last row far ahead (no asset) closes all."""
    rows = eval_input(spark, sf).select("event_id", "asset_id", "timestamp", "anomaly_pred")
    src, sink = scratch_path(spark, "rate-src"), scratch_path(spark, "rate-out")
    rows.limit(0).write.parquet(src)
    agg = stream_anomaly_rate(spark.readStream.schema(rows.schema).parquet(src), "timestamp", "asset_id")
    q = (agg.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", sink + "-ckpt").outputMode("append").start())
    try:
        replay(spark, rows, "timestamp", 3, src, q.processAllAvailable)
        end = rows.agg(F.max("timestamp").alias("timestamp")).select(
            F.lit(None).alias("event_id"), F.lit(None).alias("asset_id"),
            (F.col("timestamp") + F.expr("INTERVAL 2 DAYS")).alias("timestamp"), F.lit(None).alias("anomaly_pred"))
        end.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema.fields]).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    return r6(spark.read.parquet(sink))


# ---------------------------------------------------------------------------
# Single-operator forms of W6, W8, M1, M9, M12, S4, S5
# ---------------------------------------------------------------------------

@query("local_zscore")
def q_local_zscore(spark, sf):
    feats = fe.wrangle_and_features(fx.telemetry_events(spark, sf), EV)
    return r6(feats.select("event_id", *[f"{s}_zscore" for s in EV.sensors]))


@query("lookahead_check")
def q_lookahead_check(spark, sf):
    """Causal features of rows up to t are identical whether or not later rows exist:
    (rows compared, rows that differ) with t = the 60th-percentile timestamp."""
    f1 = fx.telemetry_events(spark, sf)
    t = percentiles(f1.select(F.unix_micros(F.col("timestamp").cast("timestamp")).alias("us")), "us", [0.6])[0]
    cut = F.unix_micros(F.col("timestamp").cast("timestamp")) <= F.lit(int(t))
    names = fe.derived_names(EV.sensors)
    full = fe.wrangle_and_features(f1, EV, causal=True).filter(cut).select("event_id", *names)
    trunc = fe.wrangle_and_features(f1.filter(cut), EV, causal=True).select(
        "event_id", *[F.col(n).alias(f"t_{n}") for n in names])
    j = full.join(trunc, "event_id", "full")
    differs = None
    for n in names:
        d = ~F.col(n).eqNullSafe(F.col(f"t_{n}"))
        differs = d if differs is None else differs | d
    return j.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(differs.cast("long")).alias("n_differ"))


@query("standardize")
def q_standardize(spark, sf):
    feats, cols = events_model_input(spark, sf)
    scaler = fit_scaler(feats.filter(F.col(SPLIT) == "train"), cols)
    return r6(scaler.transform(feats).select("event_id", SPLIT, *cols))


@query("fit_threshold")
def q_fit_threshold(spark, sf):
    """p99 of the flagship model's train scores (one row)."""
    scored = events_scored(spark, sf)
    t = fit_threshold(scored.filter(F.col(SPLIT) == "train"), 99.0)
    n = scored.groupBy(SPLIT).agg(F.sum("anomaly_pred").cast("long").alias("n_pred"),
                                  F.count(F.lit(1)).alias("n_rows"))
    return r6(n.withColumn("threshold", F.lit(t)))


@query("select_k")
def q_select_k(spark, sf):
    """K search with the sampled Euclidean silhouette: best K and the table (rows-only)."""
    v = fx.vectors(spark, sf)
    best, res = select_k(v, fx.vector_columns(v), "vec_id", PipelineConfig().k_range,
                         fit=lambda d, c, k: fit_kmeans(d, c, k, seed=42, n_init=1))
    return r6(elbow_table(spark, res).withColumn("best", (F.col("k") == best).cast("int")))


@query("model_sink")
def q_model_sink(spark, sf):
    """Train, persist, and read the persisted centre table back (rows-only)."""
    f1 = fx.telemetry_events(spark, sf)
    out = scratch_path(spark, "model")
    jobs.train(f1, EV, JOB_CONFIG, key="event_id", out_dir=out)
    return r6(spark.read.parquet(f"{version_path(spark, f'{out}/model')}/centres"))


QUERIES["model_source"] = q_detect_job


# ---------------------------------------------------------------------------
# The reference's own layout (19 columns, 16 assets, 43 modelling features)
# ---------------------------------------------------------------------------

@query("reference_layout_train")
def q_reference_layout(spark, sf):
    """Quick train (K = 5, MLlib k-means) on the reference-shaped table; metrics per split."""
    df = fx.telemetry_reference(spark, sf)
    rep = jobs.train(df, REFERENCE_SPEC, PipelineConfig(train_days=21), quick=True,
                     expect={"cols": 19, "assets": 16})
    return r6(rep.metrics)
