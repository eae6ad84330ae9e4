"""The detector as pyspark.ml stages."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from vigil.operators.cluster import stable
from vigil.operators.estimator import AnomalyDetector, AnomalyDetectorModel, AnomalyEvaluator
from vigil.operators.evaluate import evaluate
from vigil.registry import scratch_path

COLS = ["a", "b c"]


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(3)
    x = np.concatenate((r.normal(0, 1, (150, 2)), r.normal(9, 1, (150, 2)), r.uniform(-20, 30, (15, 2))))
    rows = [(i, float(p[0]), float(p[1]) * 100, int(i >= 300), i % 3, 0.5) for i, p in enumerate(x)]
    return stable(spark.createDataFrame(rows, "id long, a double, `b c` double, anomaly_label int, fold int, threshold double"))


def scores(df):
    return {r["id"]: (round(r["anomaly_score"], 9), r["anomaly_pred"]) for r in df.collect()}


def test_model_scores_and_survives_a_round_trip(spark, table):
    df = table.withColumnRenamed("b c", "b")
    est = AnomalyDetector(inputCols=["a", "b"], k=2, percentile=95.0)
    model = est.fit(df)
    out = model.transform(df)
    assert out.columns == [*df.columns, "anomaly_score", "anomaly_pred"]
    x = np.array([[r["a"], r["b"]] for r in df.orderBy("id").collect()])
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    c = np.array(model.getOrDefault("centres")).reshape(2, 2)
    want = np.sqrt(((z[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1))
    got = scores(out)
    assert np.allclose([got[i][0] for i in range(len(x))], want)
    assert [got[i][1] for i in range(len(x))] == (want >= np.quantile(want, 0.95)).astype(int).tolist()
    path = scratch_path(spark, "t-ml")
    model.save(path + "/model")
    est.save(path + "/est")
    assert scores(AnomalyDetectorModel.load(path + "/model").transform(df)) == got
    again = AnomalyDetector.load(path + "/est")
    assert again.getOrDefault("k") == 2 and scores(again.fit(df).transform(df)) == got
    whole = Pipeline(stages=[est]).fit(df)
    whole.save(path + "/pipeline")
    assert scores(PipelineModel.load(path + "/pipeline").transform(df)) == got


def test_grid_over_clusters_and_percentile_on_time_folds(table):
    df = table.withColumnRenamed("b c", "b")
    est = AnomalyDetector(inputCols=["a", "b"])
    grid = ParamGridBuilder().addGrid(est.k, [1, 2]).addGrid(est.percentile, [80.0, 95.0]).build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=AnomalyEvaluator(metricName="f1"), numFolds=3, foldCol="fold")
    fitted = cv.fit(df)
    for g, avg in zip(grid, fitted.avgMetrics):
        own = [evaluate(est.fit(df.filter(F.col("fold") != f), g).transform(df.filter(F.col("fold") == f)), "anomaly_label", fault=None).first()["f1"]
               for f in range(3)] if g[est.k] == 2 and g[est.percentile] == 95.0 else None
        assert own is None or np.isclose(avg, np.mean(own))
    best = grid[int(np.argmax(fitted.avgMetrics))]
    assert best[est.k] == 2 and fitted.bestModel.getOrDefault("k") == 2


def test_evaluator_without_positives_is_zero(table):
    df = table.withColumnRenamed("b c", "b")
    out = AnomalyDetector(inputCols=["a", "b"], k=1).fit(df).transform(df.withColumn("anomaly_label", F.lit(0)))
    assert AnomalyEvaluator().evaluate(out) == 0.0 and AnomalyEvaluator().isLargerBetter()
    assert AnomalyEvaluator().evaluate(out.limit(0)) == 0.0
