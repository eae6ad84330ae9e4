"""The detector as ``pyspark.ml`` stages: an Estimator over feature columns, its Model and an Evaluator.

They take a feature table (see ``wrangle_and_features``), so they go into a ``Pipeline`` or a ``CrossValidator``
grid over the number of clusters and the threshold percentile, with ``foldCol`` naming time blocks. All
state is in parameters: stages are written and read by the library's own writers, without pickles.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from vigil.operators.cluster import fit_kmeans, stable
from vigil.operators.evaluate import evaluate
from vigil.operators.scale import Scaler, fit_scaler
from vigil.operators.score import PRED, SCORE, CentroidModel, add_score, fit_threshold, threshold_predict


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "feature columns", TypeConverters.toListString)
    k = Param(Params._dummy(), "k", "number of clusters", TypeConverters.toInt)
    percentile = Param(Params._dummy(), "percentile", "percentile of the training scores that is the threshold", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the k-means start", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "passes of k-means at most", TypeConverters.toInt)
    scoreCol = Param(Params._dummy(), "scoreCol", "score column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)

    def value(self, name: str):
        return self.getOrDefault(name)


class AnomalyDetector(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Scaler, k-means and percentile threshold from the rows it is fitted to."""

    @keyword_only
    def __init__(self, *, inputCols=None, k=5, percentile=99.0, seed=42, maxIter=30, scoreCol=SCORE, predictionCol=PRED) -> None:
        super().__init__()
        self._setDefault(k=5, percentile=99.0, seed=42, maxIter=30, scoreCol=SCORE, predictionCol=PRED)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "AnomalyDetectorModel":
        cols = self.value("inputCols")
        rows = stable(dataset.select(*cols))  # three passes read it
        scaler = fit_scaler(rows, cols)
        scaled = scaler.transform(rows)
        clusterer, _ = fit_kmeans(scaled, cols, self.value("k"), seed=self.value("seed"), max_iter=self.value("maxIter"), n_init=1)
        threshold = fit_threshold(add_score(scaled, clusterer), self.value("percentile"))
        model = AnomalyDetectorModel()
        model._set(means=list(scaler.mean), scales=list(scaler.scale), centres=[v for c in clusterer.centres for v in c], threshold=threshold)
        return self._copyValues(model)


class AnomalyDetectorModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the score and the prediction; all other columns stay as they are."""

    means = Param(Params._dummy(), "means", "mean of each feature", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "scale of each feature", TypeConverters.toListFloat)
    centres = Param(Params._dummy(), "centres", "cluster centres, one after the other", TypeConverters.toListFloat)
    threshold = Param(Params._dummy(), "threshold", "scores from here on are anomalies", TypeConverters.toFloat)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(scoreCol=SCORE, predictionCol=PRED)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols, flat = self.value("inputCols"), self.value("centres")
        centres = tuple(tuple(flat[i: i + len(cols)]) for i in range(0, len(flat), len(cols)))
        own = [f"_vg_scaled_{i}" for i in range(len(cols))]
        scaled = Scaler(tuple(cols), tuple(self.value("means")), tuple(self.value("scales"))).exprs()
        out = dataset.select("*", *[e.alias(n) for e, n in zip(scaled, own)])
        out = add_score(out, CentroidModel(tuple(own), centres), self.value("scoreCol")).drop(*own)
        return threshold_predict(out, self.value("threshold"), self.value("scoreCol"), self.value("predictionCol"))


class AnomalyEvaluator(Evaluator, DefaultParamsReadable, DefaultParamsWritable):
    """One of the metrics of ``evaluate``; 0 where it is not defined (no positive label)."""

    metricName = Param(Params._dummy(), "metricName", "precision, recall, f1, roc_auc or pr_auc", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "score column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, metricName="f1", labelCol="anomaly_label", scoreCol=SCORE, predictionCol=PRED) -> None:
        super().__init__()
        self._setDefault(metricName="f1", labelCol="anomaly_label", scoreCol=SCORE, predictionCol=PRED)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _evaluate(self, dataset: DataFrame) -> float:
        get = self.getOrDefault
        row = evaluate(dataset, get("labelCol"), get("predictionCol"), get("scoreCol"), None).first()
        return float(row[get("metricName")] or 0.0) if row is not None else 0.0

    def isLargerBetter(self) -> bool:
        return True
