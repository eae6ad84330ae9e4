"""EM, PCA and mini-batch fits against NumPy."""

import numpy as np
import pytest

from vigil.operators import cluster as cl
from vigil.operators import mixture as mx
from vigil.operators import scale
from vigil.operators.score import CentroidModel, MixtureModel
from vigil.plans.sums import array_sums

COLS = ["x0", "x1", "x2"]


@pytest.fixture(scope="module")
def points(spark):
    r = np.random.default_rng(1)
    a = r.multivariate_normal([0, 0, 0], [[1, 0.6, 0], [0.6, 1, 0], [0, 0, 0.2]], 300)
    b = r.multivariate_normal([4, 4, 1], np.diag([0.5, 0.5, 2.0]), 200)
    x = np.concatenate((a, b))
    return x, cl.stable(spark.createDataFrame([tuple(map(float, v)) for v in x], ", ".join(f"{c} double" for c in COLS)).repartition(3))


def test_sums_of_arrays(spark, points):
    x, df = points
    got = array_sums(df, COLS, lambda y: np.append(y.sum(axis=0), len(y)), 4)
    assert np.allclose(got, [*x.sum(axis=0), len(x)])
    assert array_sums(df.limit(0), COLS, lambda y: y.sum(axis=0), 3).tolist() == [0, 0, 0]


def slow_em(x, w, m, c, ridge):
    d = x.shape[1]
    dens = np.stack([wk * np.exp(-0.5 * np.einsum("ni,ij,nj->n", x - mk, np.linalg.inv(ck + ridge * np.eye(d)), x - mk))
                     / np.sqrt((2 * np.pi) ** d * np.linalg.det(ck + ridge * np.eye(d))) for wk, mk, ck in zip(w, m, c)], axis=1)
    r = dens / dens.sum(axis=1, keepdims=True)
    n = r.sum(axis=0)
    m = r.T @ x / n[:, None]
    c = [np.einsum("n,ni,nj->ij", r[:, k], x - m[k], x - m[k]) / n[k] for k in range(len(n))]
    return n / n.sum(), m, c, np.log(dens.sum(axis=1)).sum()


def test_em_steps_equal_numpy_and_the_likelihood_never_falls(points):
    x, df = points
    w, m, c = np.array([0.5, 0.5]), np.array([[0.0, 1, 0], [3.0, 3, 3]]), [np.eye(3)] * 2
    start = MixtureModel(tuple(COLS), tuple(w), tuple(map(tuple, m)), tuple(tuple(map(tuple, k)) for k in c), 1e-6)
    model, history = mx.gmm_fixed_init(df, start, 6)
    for step in range(6):
        w, m, c, ll = slow_em(x, w, m, c, 1e-6)
        assert np.isclose(history[step], ll)
    assert np.allclose(model.weights, w) and np.allclose(model.means, m) and np.allclose(model.covs, c)
    assert all(b >= a - 1e-6 for a, b in zip(history, history[1:]))


def test_densities_far_away_are_not_floored(points):
    _, df = points
    start = MixtureModel(tuple(COLS), (0.5, 0.5), ((1e3, 1e3, 1e3), (-1e3, -1e3, 1e3)), (tuple(map(tuple, np.eye(3))),) * 2, 1e-6)
    model, history = mx.gmm_fixed_init(df, start, 3)
    assert np.isfinite(history).all() and np.isfinite(model.means).all() and abs(sum(model.weights) - 1) < 1e-12


def test_fitted_mixture_finds_both_groups(points):
    x, df = points
    model, ll = cl.fit_gmm(df, COLS, 2, n_init=2)
    assert sorted(np.round(model.weights, 1)) == [0.4, 0.6]
    assert np.isclose(ll, cl.log_likelihood(df, model))
    hard = mx.from_centres(df, CentroidModel(tuple(COLS), ((0.0, 0.0, 0.0), (4.0, 4.0, 1.0), (1e4, 1e4, 1e4))))
    assert ll >= cl.log_likelihood(df, hard) - 1e-6 and hard.weights[2] < 1e-12


def test_pca_equals_numpy(points):
    x, df = points
    n, mean, cov = scale.co_moments(df, COLS)
    assert n == len(x) and np.allclose(mean, x.mean(axis=0)) and np.allclose(cov, np.cov(x.T, bias=True))
    proj = scale.fit_pca(df, COLS, 2)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    assert np.allclose(proj.explained_variance_ratio, values[::-1][:2] / values.sum())
    assert np.allclose(np.abs(proj.components), np.abs(vectors.T[::-1][:2]))
    steps = scale.pca_fixed_steps(df, COLS, np.eye(3)[:2].tolist(), 200)
    assert np.allclose(np.abs(steps.components), np.abs(proj.components), atol=1e-6)
    with pytest.raises(ValueError):
        scale.co_moments(df.limit(0), COLS)


def test_co_moments_hold_far_from_zero(spark, points):
    x, df = points
    far = df.selectExpr(*[f"{c} + 1e8 AS {c}" for c in COLS])
    assert np.allclose(scale.co_moments(far, COLS)[2], np.cov(x.T, bias=True), rtol=1e-4)


def test_minibatch_stops_inside_few_passes_and_shares_slices(spark, points):
    _, df = points
    slices = cl.minibatch_slices(df, COLS, batch_size=20)
    assert slices.rounds == 10 and sum(slices.round(spark, r).count() for r in range(10)) == 500
    used = {}
    model, cost = cl.fit_minibatch_kmeans(df, COLS, 2, batch_size=20, slices=slices, report=used)
    full, least = cl.fit_kmeans(df, COLS, 2, n_init=2)
    assert used["passes"] <= 8 and cost <= 1.05 * least
    three, _ = cl.fit_minibatch_kmeans(df, COLS, 3, slices=slices)
    assert three.k == 3
    one, _ = cl.fit_minibatch_kmeans(df.limit(1), COLS, 1)
    assert one.k == 1
    with pytest.raises(ValueError):
        cl.fit_minibatch_kmeans(df.limit(0), COLS, 2)


def test_all_starts_of_a_mixture_take_their_steps_in_one_pass(points, monkeypatch):
    x, df = points
    passes = []
    monkeypatch.setattr(mx, "array_sums", lambda *a: passes.append(1) or array_sums(*a))
    model, ll = cl.fit_gmm(df, COLS, 2, n_init=3, max_iter=4, tol=0.0)
    assert len(passes) == 1 + 4 + 1       # hard starts, steps, likelihoods
    many = cl.fit_gmms(df, COLS, [2, 3], n_init=3, max_iter=4, tol=0.0)
    assert len(passes) == 2 * (1 + 4 + 1)
    assert np.isclose(many[0][1], ll) and np.allclose(many[0][0].means, model.means)
    alone = [mx.gmm_fixed_init(df, mx.from_centres(df, cl.fit_kmeans(df, COLS, 3, seed=42 + i, max_iter=50, n_init=1)[0]), 4)[0] for i in range(3)]
    assert np.isclose(many[1][1], max(cl.log_likelihood(df, m) for m in alone))


def test_starts_of_a_mixture_stop_one_by_one(points):
    _, df = points
    unit = (tuple(map(tuple, np.eye(3))),) * 2
    starts = [MixtureModel(tuple(COLS), (0.5, 0.5), means, unit) for means in (((0.0, 0.0, 0.0), (4.0, 4.0, 1.0)), ((1.0, 1.5, 0.0), (1.5, 1.0, 1.0)))]
    together = mx.gmms_fixed_init(df, starts, 50, 1e-3)
    for start, (model, history) in zip(starts, together):
        alone, past = mx.gmm_fixed_init(df, start, 50, 1e-3)
        assert len(past) == len(history) and np.allclose(past, history) and np.allclose(model.means, alone.means)
    assert len({len(h) for _, h in together}) == 2


def test_starts_of_kmeans_run_side_by_side(points, monkeypatch):
    from threading import Barrier

    from pyspark.ml.clustering import KMeans
    _, df = points
    vec, fit, both = cl.fit_input(df, COLS), KMeans.fit, Barrier(2, timeout=30)
    alone = [cl.fit_kmeans(df, COLS, 3, seed=42 + i, n_init=1, vec=vec) for i in range(2)]
    monkeypatch.setattr(KMeans, "fit", lambda self, d: both.wait() is not None and fit(self, d))
    model, cost = cl.fit_kmeans(df, COLS, 3, n_init=2, vec=vec)
    assert (model, cost) == min(alone, key=lambda r: r[1])
