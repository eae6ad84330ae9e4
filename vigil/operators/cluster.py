"""Clustering of normal behaviour: k-means (Lloyd, mini-batch, MLlib k-means||), Gaussian
mixtures, silhouette, K selection and cluster-quality indices.

Model state (K × d centres, K covariances) is collected; rows never are. Iterative fits read
a checkpointed copy of the train features (lineage cut in ``spark.checkpoint.dir``), so a
lost executor re-reads that table instead of recomputing the feature windows.
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.vector import nearest
from vigil.operators.score import CentroidModel, MixtureModel
from vigil.session import checkpointed, ensure_checkpoint_dir


def stable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (cuts lineage for iterative fits)."""
    return checkpointed(df)


def lowest_key_centres(df: DataFrame, cols: Sequence[str], key: str, k: int) -> list[list[float]]:
    """The K rows with the lowest ``key`` as initial centres (deterministic; top-k, no sort of all rows)."""
    rows = df.orderBy(key).limit(k).select(*cols).collect()
    return [[float(v) for v in r] for r in rows]


def lloyd_step(points: DataFrame, cols: Sequence[str], centres: list[list[float]]):
    """One assignment + mean update; empty clusters keep their centre. Returns (centres, cost)."""
    near = nearest(cols, centres)
    assigned = points.select(near.getField("cluster").alias("_c"), near.getField("d2").alias("_d2"), *cols)
    rows = assigned.groupBy("_c").agg(F.sum("_d2").alias("_cost"), *[F.avg(c).alias(c) for c in cols]).collect()
    new = [list(c) for c in centres]
    cost = 0.0
    for r in rows:
        new[int(r["_c"])] = [float(r[c]) for c in cols]
        cost += float(r["_cost"])
    return new, cost


def kmeans_fixed_init(points: DataFrame, cols: Sequence[str], init: list[list[float]], steps: int,
                      checkpoint: bool = True) -> tuple[CentroidModel, list[float]]:
    """``steps`` Lloyd updates from given centres. Returns the model and the cost before each
    update (assignment cost under the centres in force at that step)."""
    pts = stable(points.select(*cols)) if checkpoint else points.select(*cols)
    centres = [list(map(float, c)) for c in init]
    costs = []
    for _ in range(steps):
        centres, cost = lloyd_step(pts, cols, centres)
        costs.append(cost)
    return CentroidModel(tuple(cols), tuple(tuple(c) for c in centres)), costs


def inertia(points: DataFrame, model: CentroidModel) -> float:
    """Σ squared distance to the own (nearest) centre."""
    d2 = nearest(model.columns, model.centres).getField("d2")
    return float(points.agg(F.sum(d2).alias("i")).first()["i"] or 0.0)


ROWS_PER_FIT_PARTITION = 50_000
PARALLEL_FITS = 10    # fits whose Spark jobs run side by side


def concurrently(fit: Callable, items: Sequence) -> list:
    """``fit`` of each item, in order. A step of a fit is a short job: side by side, they fill each other's waits and share the cores."""
    items = list(items)
    if len(items) < 2:
        return [fit(i) for i in items]
    with ThreadPoolExecutor(max_workers=min(len(items), PARALLEL_FITS)) as pool:
        return list(pool.map(fit, items))


def fit_input(df: DataFrame, cols: Sequence[str], n_parts: int | None = None) -> DataFrame:
    """Assembled vectors, checkpointed, in a partition count fixed by the row count alone (MLlib's
    result for a seed depends on the partitioning, so it must drift neither with AQE nor with the
    cluster)."""
    if n_parts is None:
        n_parts = max(1, -(-df.count() // ROWS_PER_FIT_PARTITION))
    return stable(_assemble(df, cols).repartition(n_parts))


def _assemble(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(df.select(*cols))


def fit_kmeans(train: DataFrame, cols: Sequence[str], k: int, seed: int = 42, max_iter: int = 500,
               n_init: int = 10, tol: float = 1e-4, n_parts: int | None = None,
               vec: DataFrame | None = None) -> tuple[CentroidModel, float]:
    """Distributed Lloyd (MLlib, k-means|| init) over ``n_init`` seeds, fitted side by side; keeps the lowest cost.

    The input is repartitioned to a fixed count first: MLlib's result depends on the
    partitioning for a given seed.
    """
    from pyspark.ml.clustering import KMeans

    if k == 1:  # the mean; MLlib asks for two clusters or more
        centre = tuple(float(v or 0.0) for v in train.agg(*[F.avg(c) for c in cols]).first())
        model = CentroidModel(tuple(cols), (centre,))
        return model, inertia(train, model)
    vec = vec if vec is not None else fit_input(train, cols, n_parts)

    def one(i: int) -> tuple[CentroidModel, float]:
        m = KMeans(k=k, seed=seed + i, maxIter=max_iter, tol=tol, featuresCol="features").fit(vec)
        centres = tuple(tuple(float(v) for v in c) for c in m.clusterCenters())
        return CentroidModel(tuple(cols), centres), float(m.summary.trainingCost)

    return min(concurrently(one, range(n_init)), key=lambda fit: fit[1])   # the first of the lowest


@dataclass(frozen=True)
class Slices:
    """Rows hashed into slices of about ``batch_size``, written once below the shared checkpoint folder by round:
    a round's folder is all that its Spark job reads."""

    path: str
    rounds: int
    n: int
    cols: tuple[str, ...]

    def round(self, spark, r: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/_r={r % self.rounds}").sortWithinPartitions("_b")


def minibatch_slices(train: DataFrame, cols: Sequence[str], seed: int = 42, batch_size: int = 4096, key: str | None = None,
                     rounds: int = 10) -> Slices:
    """Slices for ``fit_minibatch_kmeans``, the same for every K. A slice is never split between tasks."""
    hashed = F.xxhash64(*([F.col(key)] if key else [F.col(c) for c in cols]), F.lit(seed))
    n = train.count()
    if n == 0:
        raise ValueError("no train rows")
    n_batches = max(1, -(-n // batch_size))
    rounds = min(rounds, n_batches)
    n_parts = max(1, -(-n // (rounds * ROWS_PER_FIT_PARTITION)))
    path = f"{ensure_checkpoint_dir(train.sparkSession).rstrip('/')}/slices-{uuid.uuid4().hex[:12]}"
    (train.select(*[F.col(c).cast("double").alias(c) for c in cols], F.pmod(hashed, F.lit(n_batches)).alias("_b"))
     .withColumn("_r", F.pmod("_b", F.lit(rounds))).withColumn("_p", F.pmod(F.floor(F.col("_b") / rounds), F.lit(n_parts)))
     .repartition(rounds * n_parts, "_r", "_p").sortWithinPartitions("_r", "_p", "_b").drop("_p").write.partitionBy("_r").parquet(path))
    return Slices(path, rounds, n, tuple(cols))


def fit_minibatch_kmeans(train: DataFrame, cols: Sequence[str], k: int, seed: int = 42,
                         batch_size: int = 4096, max_iter: int = 300, patience: int = 10, tol: float = 1e-3,
                         key: str | None = None, slices: Slices | None = None,
                         report: dict | None = None) -> tuple[CentroidModel, float]:
    """Mini-batch k-means over all rows in rounds, at most ``max_iter`` passes over them.

    A round is one Spark job over a tenth of the slices (all, if there are fewer than ten): each task takes its
    slices one after the other, assigns each and moves each centre toward the slice mean with per-centre learning
    rate 1 / (points seen so far); the tasks' sums are then added up. The mean cost of the rounds is
    smoothed by the share of rows that a round holds, and the fit ends when ``patience`` rounds have not lowered
    it by the share ``tol``, which is inside the second or third pass as a rule. Initial centres: MLlib k-means|| on the first round.
    ``report`` receives the rounds and passes used."""
    cols, spark = list(cols), train.sparkSession
    slices = slices or minibatch_slices(train, cols, seed, batch_size, key)
    model0, _ = fit_kmeans(slices.round(spark, 0), cols, k, seed=seed, max_iter=20, n_init=1)
    centres = np.array(model0.centres)
    counts = np.zeros(len(centres))
    width = len(cols) + 2

    def one_round(part: DataFrame, centres: np.ndarray, counts: np.ndarray) -> np.ndarray:
        def run(batches):
            c, seen = centres.copy(), counts.copy()
            sums, held = np.zeros((len(c), width)), []

            def step(x: np.ndarray) -> None:
                d2 = (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None] - 2 * x @ c.T
                near = d2.argmin(axis=1)
                m = np.bincount(near, minlength=len(c))
                s = np.zeros_like(c)
                np.add.at(s, near, x)
                seen[:] += m
                hit = m > 0
                c[hit] += (s - m[:, None] * c)[hit] / seen[hit, None]
                sums[:, 0] += m
                sums[:, 1] += np.bincount(near, weights=np.maximum(d2.min(axis=1), 0), minlength=len(c))
                sums[:, 2:] += s

            for b in batches:  # a slice may run over the end of a batch
                held = [pa.Table.from_batches([*(t for h in held for t in h.to_batches()), b]).combine_chunks()]
                ids = held[0]["_b"].to_numpy()
                cuts = np.flatnonzero(np.diff(ids)) + 1
                if len(cuts):
                    x = np.column_stack([held[0][n].to_numpy() for n in cols])
                    for one in np.split(x[: cuts[-1]], cuts[:-1]):
                        step(one)
                    held = [held[0].slice(cuts[-1])]
            if held and held[0].num_rows:
                step(np.column_stack([held[0][n].to_numpy() for n in cols]))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.ravel())], names=["i", "v"])

        got = part.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(len(centres) * width)
        out[got["i"].to_numpy()] = got["v"].to_numpy()
        return out.reshape(len(centres), width)

    smooth, best, stale, rounds = None, math.inf, 0, 0
    for r in range(max_iter * slices.rounds):
        got = one_round(slices.round(spark, r), centres, counts)
        m = got[:, 0]
        hit = m > 0
        centres[hit] = (counts[hit, None] * centres[hit] + got[hit, 2:]) / (counts + m)[hit, None]
        counts += m
        rounds = r + 1
        if not m.sum():
            continue
        cost, alpha = got[:, 1].sum() / m.sum(), min(1.0, 2.0 * m.sum() / (slices.n + 1))
        smooth = cost if smooth is None else smooth * (1 - alpha) + cost * alpha
        best, stale = (smooth, 0) if smooth < best * (1 - tol) else (best, stale + 1)
        if stale >= patience:
            break
    if report is not None:
        report.update(rounds=rounds, passes=rounds / slices.rounds)
    model = CentroidModel(tuple(cols), tuple(tuple(c) for c in centres.tolist()), kind="minibatch")
    return model, inertia(train, model)


def fit_gmm(train: DataFrame, cols: Sequence[str], k: int, seed: int = 42, max_iter: int = 200,
            n_init: int = 3, tol: float = 1e-3, vec: DataFrame | None = None,
            is_stable: bool = False) -> tuple[MixtureModel, float]:
    """Full-covariance mixture by expectation-maximisation (see ``vigil.operators.mixture``) over ``n_init`` k-means
    starts; keeps the highest log-likelihood. ``tol`` is its gain a row under which a start ends. ``is_stable``:
    ``train`` reads a materialised copy already; ``vec`` is the k-means input, shared between fits."""
    return fit_gmms(train, cols, [k], seed, max_iter, n_init, tol, vec, is_stable)[0]


def fit_gmms(train: DataFrame, cols: Sequence[str], ks: Sequence[int], seed: int = 42, max_iter: int = 200,
             n_init: int = 3, tol: float = 1e-3, vec: DataFrame | None = None,
             is_stable: bool = False) -> list[tuple[MixtureModel, float]]:
    """``fit_gmm`` for each K. All starts of all K take a step in the same pass over the rows."""
    from vigil.operators.mixture import each_from_centres, gmms_fixed_init, log_likelihoods

    points = train.select(*cols)
    points = points if is_stable else stable(points)
    vec = vec if vec is not None else fit_input(points, cols)
    runs = [(k, seed + i) for k in ks for i in range(n_init)]
    centres = concurrently(lambda r: fit_kmeans(points, cols, r[0], seed=r[1], max_iter=50, n_init=1, vec=vec)[0], runs)
    models = [m for m, _ in gmms_fixed_init(points, each_from_centres(points, centres), max_iter, tol)]
    scored = list(zip(models, log_likelihoods(points, models)))
    return [max(scored[j * n_init: (j + 1) * n_init], key=lambda fit: fit[1]) for j in range(len(ks))]


def em_points(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Materialised copy for mixture fits. A row costs K d² products a step, so a small table is spread over all cores too."""
    n = df.count()
    parts = max(-(-n // ROWS_PER_FIT_PARTITION), min(df.sparkSession.sparkContext.defaultParallelism, -(-n // 500)), 1)
    return stable(df.select(*cols).repartition(parts))


def log_likelihood(df: DataFrame, model: MixtureModel) -> float:
    from vigil.operators.score import add_score
    s = add_score(df.select(*model.columns), model, "_nl")
    return -float(s.agg(F.sum("_nl").alias("s")).first()["s"])


def gmm_information(df: DataFrame, model: MixtureModel) -> dict:
    """BIC / AIC of a full-covariance mixture: p = K·d(d+3)/2 + K - 1 free parameters."""
    d, k = len(model.columns), model.k
    n = df.count()
    ll = log_likelihood(df, model)
    p = k * d * (d + 3) / 2 + k - 1
    return {"k": k, "log_likelihood": ll, "n_params": int(p),
            "bic": -2 * ll + p * math.log(n), "aic": -2 * ll + 2 * p}


# ---------------------------------------------------------------------------
# Silhouette (Euclidean) on a bounded, deterministic sample
# ---------------------------------------------------------------------------

def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement: the n smallest xxhash64(key, seed). Stable under any
    partitioning (unlike ``rand(seed)``); top-n, so no full sort."""
    return df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))).orderBy("_h", key).limit(n).drop("_h")


def silhouette(sample: DataFrame, cols: Sequence[str], label: str, key: str) -> float:
    """Mean Euclidean silhouette of an already bounded sample (≤ a few thousand rows).

    a(i) = mean distance to the other members of its cluster, b(i) = smallest mean distance
    to another cluster, s(i) = (b - a) / max(a, b), 0 for singleton clusters.
    """
    return silhouette_by_label(sample, cols, [label], key)[label]


def silhouette_by_label(sample: DataFrame, cols: Sequence[str], labels: Sequence[str], key: str) -> dict:
    """Silhouettes of several labelings (columns of a bounded sample DataFrame)."""
    cols, labels = list(cols), list(labels)
    local = sample.select(*labels, *cols).toPandas()      # bounded: ≤ the sample size
    if len(local) == 0:
        return {l: float("nan") for l in labels}
    X = local[cols].to_numpy(dtype=float)
    return silhouette_scores(sample.sparkSession, X, {l: local[l].to_numpy() for l in labels})


def silhouette_scores(spark, X: np.ndarray, label_sets: dict) -> dict:
    """Mean Euclidean silhouette of the bounded sample ``X`` under each labeling.

    ``X`` and the labels are broadcast (a proven bound: the sample size); tasks take slices
    of row indices and compute their distances to all sample points with NumPy in blocks,
    so no pair rows are ever materialised and no expression grows with K or d.
    """
    import pandas as pd
    from pyspark.sql.types import DoubleType, StructField, StructType

    n = len(X)
    names = list(label_sets)
    bc = spark.sparkContext.broadcast((X, [np.asarray(label_sets[l]) for l in names]))

    def run(batches):
        Xs, labs = bc.value
        sq = (Xs * Xs).sum(axis=1)
        for pdf in batches:
            idx = pdf["id"].to_numpy()
            res = np.zeros((len(idx), len(labs)))
            for lo in range(0, len(idx), 512):
                ii = idx[lo:lo + 512]
                q = Xs[ii]
                d = np.sqrt(np.clip((q * q).sum(axis=1)[:, None] + sq[None, :] - 2.0 * q @ Xs.T, 0.0, None))
                for j, ys in enumerate(labs):
                    own = ys[ii]
                    ks = np.unique(ys)
                    sums = np.stack([d[:, ys == c].sum(axis=1) for c in ks], axis=1)
                    cnt = np.array([(ys == c).sum() for c in ks], dtype=float)
                    mine = own[:, None] == ks[None, :]
                    n_own = (cnt[None, :] * mine).sum(axis=1)
                    a = np.where(n_own > 1, (sums * mine).sum(axis=1) / np.maximum(n_own - 1, 1), 0.0)
                    other = np.where(mine, np.inf, sums / cnt[None, :])
                    b = other.min(axis=1) if len(ks) > 1 else np.full(len(ii), np.inf)
                    res[lo:lo + 512, j] = np.where((n_own > 1) & np.isfinite(b),
                                                   (b - a) / np.maximum(np.maximum(a, b), 1e-300), 0.0)
            yield pd.DataFrame({f"_s{j}": res[:, j] for j in range(len(labs))})

    schema = StructType([StructField(f"_s{j}", DoubleType(), True) for j in range(len(names))])
    parts = max(1, min(spark.sparkContext.defaultParallelism, -(-n // 512)))
    scores = spark.range(n).repartition(parts).mapInPandas(run, schema)
    row = scores.agg(*[F.avg(f"_s{j}").alias(f"_s{j}") for j in range(len(names))]).first()
    return {l: float(row[f"_s{j}"]) for j, l in enumerate(names)}


def assign_np(X: np.ndarray, model) -> np.ndarray:
    """Cluster of each sample row under a fitted model (NumPy; the sample is bounded)."""
    if isinstance(model, CentroidModel):
        C = np.asarray(model.centres)
        d2 = (X * X).sum(axis=1)[:, None] + (C * C).sum(axis=1)[None, :] - 2.0 * X @ C.T
        return np.argmin(d2, axis=1)
    return model.log_density_np(X)[1]


def sample_points(df: DataFrame, cols: Sequence[str], key: str, n: int, seed: int = 42) -> np.ndarray:
    """The bounded silhouette sample (at most ``n`` rows) as a NumPy matrix."""
    return hash_sample(df, key, n, seed).select(*cols).toPandas().to_numpy(dtype=float)


@dataclass
class KResult:
    k: int
    silhouette: float
    inertia: float | None
    model: object


def select_k(train: DataFrame, cols: Sequence[str], key: str, k_range: Sequence[int],
             fit: Callable[[DataFrame, Sequence[str], int], tuple] | None = None,
             sample_size: int = 5000, seed: int = 42, is_stable: bool = False) -> tuple[int, list[KResult]]:
    """Fit each K, score it by the sampled Euclidean silhouette; best = first maximum.
    ``is_stable``: ``train`` already reads a materialised copy, so none is made here."""
    base = train.select(key, *cols)
    base = base if is_stable else stable(base)
    if fit is None:
        vec = fit_input(base, cols)
        fit = (lambda d, c, k: fit_kmeans(d, c, k, seed=seed, vec=vec))
    X = sample_points(base, cols, key, sample_size, seed)
    # The fits are independent jobs: submit them concurrently so small fits share the cores
    # (on a cluster they interleave under the fair scheduler).
    with ThreadPoolExecutor(max_workers=max(1, min(len(k_range), 8))) as pool:
        fitted = list(pool.map(lambda k: (k, fit(base, cols, k)), k_range))
    results = [KResult(k, float("nan"), cost if isinstance(model, CentroidModel) else None, model)
               for k, (model, cost) in fitted]
    sils = silhouette_scores(train.sparkSession, X, {r.k: assign_np(X, r.model) for r in results})
    for r in results:
        r.silhouette = sils[r.k]
    best = max(results, key=lambda r: (r.silhouette, -r.k))
    return best.k, results


def elbow_table(spark, results: Sequence[KResult]) -> DataFrame:
    return spark.createDataFrame([(r.k, r.silhouette, r.inertia) for r in results],
                                 "k int, silhouette double, inertia double")


def davies_bouldin(points: DataFrame, model: CentroidModel) -> float:
    """Davies–Bouldin index: mean over clusters of max_j (s_i + s_j) / |c_i - c_j|, with s_i
    the mean distance of cluster i's points to its centre."""
    near = nearest(model.columns, model.centres)
    rows = (points.select(near.getField("cluster").alias("_c"), F.sqrt(near.getField("d2")).alias("_d"))
            .groupBy("_c").agg(F.avg("_d").alias("s")).collect())
    s = {int(r["_c"]): float(r["s"]) for r in rows}
    cs = np.array(model.centres)
    ids = sorted(s)
    if len(ids) < 2:
        return 0.0
    tot = 0.0
    for i in ids:
        tot += max((s[i] + s[j]) / float(np.linalg.norm(cs[i] - cs[j])) for j in ids if j != i)
    return tot / len(ids)
