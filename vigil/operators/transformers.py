"""``pyspark.ml`` wrappers, so the telemetry operators compose in an ML ``Pipeline`` and
persist with it (params only; the work is the same DataFrame operators)."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable

from vigil.config import TelemetrySpec
from vigil.operators.features import wrangle_and_features


class TelemetryFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Missing flags, bounded fills and rolling features per asset (fit is a no-op)."""

    assetCol = Param(Params._dummy(), "assetCol", "series key", TypeConverters.toString)
    orderCols = Param(Params._dummy(), "orderCols", "time column then tiebreaks", TypeConverters.toListString)
    sensorCols = Param(Params._dummy(), "sensorCols", "sensor columns", TypeConverters.toListString)
    contextCols = Param(Params._dummy(), "contextCols", "numeric context columns", TypeConverters.toListString)
    window = Param(Params._dummy(), "window", "rolling window in rows", TypeConverters.toInt)
    fillLimit = Param(Params._dummy(), "fillLimit", "max consecutive rows filled", TypeConverters.toInt)
    causal = Param(Params._dummy(), "causal", "forward fill only", TypeConverters.toBoolean)
    addDiff = Param(Params._dummy(), "addDiff", "first differences", TypeConverters.toBoolean)
    addZscore = Param(Params._dummy(), "addZscore", "local z-scores", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, assetCol="asset_id", orderCols=("timestamp",), sensorCols=(), contextCols=(),
                 window=15, fillLimit=5, causal=False, addDiff=True, addZscore=True):
        super().__init__()
        self._setDefault(assetCol="asset_id", orderCols=["timestamp"], sensorCols=[], contextCols=[],
                         window=15, fillLimit=5, causal=False, addDiff=True, addZscore=True)
        self._set(**self._input_kwargs)

    @classmethod
    def from_spec(cls, spec: TelemetrySpec, **kw) -> "TelemetryFeatures":
        return cls(assetCol=spec.asset, orderCols=list(spec.order), sensorCols=list(spec.sensors),
                   contextCols=list(spec.context), **kw)

    def spec(self) -> TelemetrySpec:
        order = self.getOrDefault(self.orderCols)
        return TelemetrySpec(ts=order[0], asset=self.getOrDefault(self.assetCol), tiebreak=tuple(order[1:]),
                             sensors=tuple(self.getOrDefault(self.sensorCols)),
                             context=tuple(self.getOrDefault(self.contextCols)), ids=(), extra_labels=())

    def _transform(self, dataset):
        g = self.getOrDefault
        return wrangle_and_features(dataset, self.spec(), window=g(self.window), limit=g(self.fillLimit),
                                    causal=g(self.causal), add_diff=g(self.addDiff), add_zscore=g(self.addZscore))
