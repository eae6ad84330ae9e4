"""Property checks of fitted models, persistence and the jobs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from vigil.config import EVENTS_SPEC, PipelineConfig
from vigil.operators import cluster as cl
from vigil.operators.features import label_guard, select_features, wrangle_and_features
from vigil.operators.score import MixtureModel, add_score
from vigil.plans import jobs
from vigil.sources import fixtures as fx
from vigil.sources.store import load_model, save_model

COLS = [f"x{i}" for i in range(64)]


@pytest.fixture(scope="module")
def vectors(spark):
    return fx.vectors(spark, SF_MID).cache()


def test_lloyd_cost_is_monotone(vectors):
    init = cl.lowest_key_centres(vectors, COLS, "vec_id", 4)
    _, costs = cl.kmeans_fixed_init(vectors, COLS, init, 6)
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_kmeans_beats_its_initial_centres(vectors):
    model, cost = cl.fit_kmeans(vectors, COLS, 4, seed=42, max_iter=50, n_init=2)
    init = cl.lowest_key_centres(vectors, COLS, "vec_id", 4)
    from vigil.operators.score import CentroidModel
    assert cost <= cl.inertia(vectors, CentroidModel(tuple(COLS), tuple(map(tuple, init)))) + 1e-6
    assert abs(cost - cl.inertia(vectors, model)) / cost < 1e-6


def test_minibatch_close_to_full(vectors):
    full, c_full = cl.fit_kmeans(vectors, COLS, 4, seed=42, max_iter=50, n_init=2)
    mb, c_mb = cl.fit_minibatch_kmeans(vectors, COLS, 4, seed=42, batch_size=128, max_iter=30)
    assert c_mb < 1.25 * c_full


def test_gmm_log_density_matches_closed_form(spark):
    rng = np.random.default_rng(3)
    d, k = 3, 2
    covs = []
    for _ in range(k):
        A = rng.normal(size=(d, d))
        covs.append(A @ A.T + np.eye(d))
    means = rng.normal(size=(k, d))
    w = np.array([0.3, 0.7])
    model = MixtureModel(("u", "v", "z"), tuple(w), tuple(map(tuple, means)),
                         tuple(tuple(map(tuple, c)) for c in covs), ridge=0.0)
    X = rng.normal(size=(50, d)) * 3
    df = spark.createDataFrame(pd.DataFrame(X, columns=["u", "v", "z"]))
    got = np.array([r["s"] for r in add_score(df, model, "s").collect()])
    dens = np.zeros(len(X))
    for wk, mu, c in zip(w, means, covs):
        diff = X - mu
        q = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(c), diff)
        dens += wk * np.exp(-0.5 * q) / np.sqrt((2 * np.pi) ** d * np.linalg.det(c))
    assert np.allclose(got, -np.log(dens), rtol=1e-9)
    far = spark.createDataFrame(pd.DataFrame([[1e3, -1e3, 1e3]], columns=["u", "v", "z"]))
    assert np.isfinite(add_score(far, model, "s").first()["s"])   # log space: no underflow


def test_silhouette_equals_pairwise_numpy(spark, vectors):
    s = cl.silhouette(vectors, COLS, "label", "vec_id")
    pdf = vectors.toPandas()
    X, y = pdf[COLS].to_numpy(), pdf["label"].to_numpy()
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    vals = []
    for i in range(len(X)):
        own = (y == y[i])
        a = D[i, own].sum() / (own.sum() - 1) if own.sum() > 1 else 0
        b = min(D[i, y == c].mean() for c in set(y) if c != y[i])
        vals.append((b - a) / max(a, b) if own.sum() > 1 else 0)
    assert abs(s - np.mean(vals)) < 1e-9


def test_label_guard_rejects_labels():
    with pytest.raises(ValueError):
        label_guard(["s1", "anomaly_label"], EVENTS_SPEC)
    cols = select_features(["s1", "s1_diff", "weird_diff", "regime", "load_pct"], EVENTS_SPEC)
    assert "weird_diff" not in cols and "regime" not in cols


def test_lookahead_is_bounded(spark):
    f1 = fx.telemetry_events(spark, SF_SMALL)
    ts = sorted(r[0] for r in f1.select("timestamp").collect())
    t = ts[len(ts) * 6 // 10]
    full = wrangle_and_features(f1, EVENTS_SPEC, causal=True).filter(F.col("timestamp") <= t)
    trunc = wrangle_and_features(f1.filter(F.col("timestamp") <= t), EVENTS_SPEC, causal=True)
    a = full.toPandas().sort_values("event_id").reset_index(drop=True)
    b = trunc.toPandas().sort_values("event_id").reset_index(drop=True)
    num = a.select_dtypes("number").columns
    assert np.allclose(a[num].to_numpy(float), b[num].to_numpy(float), atol=1e-12)


def test_features_invariant_to_input_partitioning(spark):
    f1 = fx.telemetry_events(spark, SF_SMALL)
    a = wrangle_and_features(f1, EVENTS_SPEC).toPandas().sort_values("event_id").reset_index(drop=True)
    b = wrangle_and_features(f1.repartition(7), EVENTS_SPEC).toPandas().sort_values("event_id").reset_index(drop=True)
    num = a.select_dtypes("number").columns
    assert np.allclose(a[num].to_numpy(float), b[num].to_numpy(float), atol=1e-12)


@pytest.mark.parametrize("model", ["lloyd", "gmm"])
def test_train_save_load_score_roundtrip(spark, tmp_path, model):
    f1 = fx.telemetry_events(spark, SF_SMALL)
    cfg = PipelineConfig(train_days=21, kmeans_n_clusters=3, model=model, extra={"lloyd_steps": 3},
                         gmm_max_iter=20, gmm_n_init=1, use_pca=(model == "gmm"), pca_n_components=4)
    rep = jobs.train(f1, EVENTS_SPEC, cfg, key="event_id")
    train_share = rep.scored.filter(F.col("split") == "train").agg(F.avg("anomaly_pred")).first()[0]
    assert 0.0 < train_share <= 0.03
    path = str(tmp_path / "m")
    save_model(spark, rep.model, path)
    back = load_model(spark, path)
    a = jobs.detect_anomalies(f1, rep.model).toPandas().sort_values("event_id").reset_index(drop=True)
    b = jobs.detect_anomalies(f1, back).toPandas().sort_values("event_id").reset_index(drop=True)
    assert np.allclose(a["anomaly_score"], b["anomaly_score"], rtol=1e-12)
    assert (a["anomaly_pred"] == b["anomaly_pred"]).all()
    assert list(a.columns) == f1.columns + ["anomaly_score", "anomaly_pred"]
    orig = f1.toPandas().sort_values("event_id").reset_index(drop=True)
    assert a["s1"].isna().sum() == orig["s1"].isna().sum()     # inputs returned unfilled


def test_missing_model_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "nothing"))


def test_train_contract_and_metrics_sink(spark, tmp_path):
    f1 = fx.telemetry_events(spark, SF_SMALL)
    cfg = PipelineConfig(train_days=21, kmeans_n_clusters=3, model="lloyd", extra={"lloyd_steps": 2})
    with pytest.raises(ValueError):
        jobs.train(f1, EVENTS_SPEC, cfg, key="event_id", expect={"rows": 230_400, "cols": 19, "assets": 16})
    out = str(tmp_path / "run")
    jobs.train(f1, EVENTS_SPEC, cfg, key="event_id", out_dir=out,
               expect={"rows": f1.count(), "cols": len(f1.columns), "assets": 15})
    m = spark.read.json(f"{out}/metrics")
    assert "silhouette" in m.columns                       # null fields are kept
    assert sum(r["n_rows"] for r in m.collect()) == f1.count()


def test_reference_layout_end_to_end(spark):
    """19 columns, 16 assets, 43 features; contract, K search and the Arrow-batch mixture path."""
    from vigil.config import REFERENCE_SPEC
    from vigil.operators.score import MixtureModel
    df = fx.telemetry_reference(spark, SF_SMALL)
    assert len(df.columns) == 19
    rep = jobs.train(df, REFERENCE_SPEC, PipelineConfig(train_days=21, k_range=(3, 4)),
                     expect={"cols": 19, "assets": 16})
    assert len(rep.model.features) == 43 and rep.best_k in (3, 4)
    assert rep.metrics.count() == 2
    gmm = PipelineConfig(train_days=21, kmeans_n_clusters=4, model="gmm", gmm_max_iter=10, gmm_n_init=1)
    rep2 = jobs.train(df, REFERENCE_SPEC, gmm)
    assert isinstance(rep2.model.clusterer, MixtureModel) and not rep2.model.clusterer.native()
    out = jobs.detect_anomalies(df, rep2.model).toPandas()
    assert len(out) == df.count() and np.isfinite(out["anomaly_score"]).all()


def test_minibatch_learns_from_all_slices(spark):
    # Far more rows than max_iter x batch_size: the centres are the means of what all rows were assigned to.
    rows = spark.range(20_000).selectExpr("id", "double(id % 2) * 10 + rand(3) AS x")
    model, _ = cl.fit_minibatch_kmeans(rows, ["x"], 2, batch_size=50, max_iter=1, key="id")
    want = [r["m"] for r in rows.groupBy((F.col("x") > 5).alias("k")).agg(F.avg("x").alias("m")).orderBy("k").collect()]
    assert sorted(c[0] for c in model.centres) == pytest.approx(want, abs=1e-9)
