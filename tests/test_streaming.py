"""Streaming scorer: late rows are kept (unscored); on-time rows equal the batch causal job."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.config import EVENTS_SPEC
from vigil.plans import jobs
from vigil.registry import JOB_CONFIG, scratch_path
from vigil.sources import fixtures as fx
from vigil.streaming import replay
from vigil.streaming.score import stream_score


def test_stream_equals_batch_and_keeps_late_rows(spark):
    f1 = fx.telemetry_events(spark, SF_SMALL)
    rep = jobs.train(f1, EVENTS_SPEC, JOB_CONFIG.with_(causal_fill=True), key="event_id")
    src, sink = scratch_path(spark, "t-src"), scratch_path(spark, "t-out")
    f1.limit(0).write.parquet(src)
    stream = spark.readStream.schema(f1.schema).parquet(src)
    q = (stream_score(stream, rep.model, ["event_id", "asset_id", "timestamp"]).writeStream
         .format("parquet").option("path", sink).option("checkpointLocation", sink + "-ck").start())
    try:
        replay(spark, f1, "timestamp", 3, src, q.processAllAvailable)
        cut = f1.agg({"timestamp": "max"}).first()[0] - dt.timedelta(days=10)
        late = f1.filter(f1.timestamp < cut)
        late.write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    out = spark.read.parquet(sink).toPandas()
    assert len(out) == f1.count() + late.count()
    assert out["anomaly_score"].isna().sum() == late.count()
    on_time = out.dropna(subset=["anomaly_score"]).sort_values("event_id").reset_index(drop=True)
    batch = jobs.detect_anomalies(f1, rep.model).toPandas().sort_values("event_id").reset_index(drop=True)
    assert (on_time["event_id"].to_numpy() == batch["event_id"].to_numpy()).all()
    assert np.allclose(on_time["anomaly_score"], batch["anomaly_score"], atol=1e-9)
    assert (on_time["anomaly_pred"].astype(int).to_numpy() == batch["anomaly_pred"].to_numpy()).all()


def test_state_keeps_small_values_and_text_ids(spark):
    """Readings of 1e-9 and a tiebreak like "001" come back from the state as they went in."""
    f1 = fx.telemetry_events(spark, SF_SMALL)
    small = f1
    for c in EVENTS_SPEC.sensors:
        small = small.withColumn(c, small[c] * 1.23456789e-9)
    small = small.withColumn("tie", F.lpad(F.col("event_id").cast("string"), 8, "0"))
    spec = EVENTS_SPEC.with_(tiebreak=("tie",))
    rep = jobs.train(small, spec, JOB_CONFIG.with_(causal_fill=True), key="event_id")
    src, sink = scratch_path(spark, "t-src"), scratch_path(spark, "t-out")
    small.limit(0).write.parquet(src)
    stream = spark.readStream.schema(small.schema).parquet(src)
    q = (stream_score(stream, rep.model, ["event_id"]).writeStream
         .format("parquet").option("path", sink).option("checkpointLocation", sink + "-ck").start())
    try:
        replay(spark, small, "timestamp", 3, src, q.processAllAvailable)
    finally:
        q.stop()
    out = spark.read.parquet(sink).toPandas().sort_values("event_id").reset_index(drop=True)
    batch = jobs.detect_anomalies(small, rep.model).toPandas().sort_values("event_id").reset_index(drop=True)
    assert len(out) == len(batch)
    assert np.allclose(out["anomaly_score"], batch["anomaly_score"], atol=1e-6)
