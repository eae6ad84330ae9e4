"""vigil — unsupervised anomaly detection on multi-asset telemetry, written as Spark jobs.

Every operator is a ``DataFrame -> DataFrame`` function (or a model-sized aggregate) so
Catalyst sees one declarative plan per job. Sub-packages:

* ``vigil.sources``   — telemetry readers, contracts, fixtures, model/metrics sinks
* ``vigil.operators`` — wrangling, features, split, profiling, scaling, clustering,
                         scoring, thresholds, evaluation, drift
* ``vigil.functions`` — column-expression builders shared by the operators
* ``vigil.plans``     — physical-layout helpers (skew-safe series chunking, distributed
                         prefix sums) and the train / score jobs
* ``vigil.streaming`` — Structured Streaming scorer and anomaly-rate monitor
"""

from vigil.config import PipelineConfig, TelemetrySpec

__all__ = ["PipelineConfig", "TelemetrySpec"]
