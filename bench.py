"""Benchmark the headline jobs at one scale factor; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from pyspark.sql import functions as F

    from vigil.config import EVENTS_SPEC as EV, LINEITEM_SPEC as LI, REFERENCE_SPEC, PipelineConfig
    from vigil.operators import evaluate as ev
    from vigil.operators.features import wrangle_and_features
    from vigil.plans import jobs
    from vigil.registry import EV_TRAIN_DAYS, eval_input, flagship
    from vigil.session import local_session
    from vigil.sources import fixtures as fx

    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8))
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    # warm-up: JVM, Python workers, codegen caches (not timed)
    fx.telemetry_events(spark, sf_dir).limit(10).collect()

    # Telemetry tables as a production job would see them: Parquet in the shared folder.
    from vigil.registry import scratch_path
    paths = {"events": scratch_path(spark, "bench-events"), "lineitem": scratch_path(spark, "bench-lineitem")}
    timed("derive_fixtures", lambda: (fx.telemetry_events(spark, sf_dir).write.parquet(paths["events"]),
                                      fx.telemetry_lineitem(spark, sf_dir).write.parquet(paths["lineitem"])))
    f1 = spark.read.parquet(paths["events"])
    f2 = spark.read.parquet(paths["lineitem"])

    timed("features_events", lambda: noop(wrangle_and_features(f1, EV)))
    timed("features_lineitem", lambda: noop(wrangle_and_features(f2, LI)))

    quick_cfg = PipelineConfig(train_days=EV_TRAIN_DAYS)
    rep = {}

    def train_quick():
        r = jobs.train(f1, EV, quick_cfg, quick=True, key="event_id")
        r.metrics.collect()
        rep["quick"] = r

    timed("train_quick_k5", train_quick)
    timed("score_detect", lambda: noop(jobs.detect_anomalies(f1, rep["quick"].model)))

    def train_full():
        r = jobs.train(f1, EV, quick_cfg, quick=False, key="event_id")
        r.metrics.collect()

    timed("train_full_ksearch", train_full)
    timed("evaluate", lambda: ev.evaluate(eval_input(spark, sf_dir), keys=["split"]).collect())

    # Longer series (lineitem telemetry: 4 sensors, ~600 rows per supplier, 6 x events rows):
    # the volume closest to the reference's 230k-row table. 70 % of the span is training.
    span = f2.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).first()
    li_cfg = PipelineConfig(train_days=int((span["b"] - span["a"]).days * 0.7))

    def train_lineitem():
        r = jobs.train(f2, LI, li_cfg, quick=True, key="rn")
        noop(r.scored)
        rep["li"] = r

    timed("train_quick_lineitem", train_lineitem)
    timed("score_detect_lineitem", lambda: noop(jobs.detect_anomalies(f2, rep["li"].model)))
    # The reference's own shape: 19 columns, 16 assets, 43 modelling features, K searched over
    # {3,4,5,6,7,8,10} by sampled silhouette (its "full pipeline").
    ref_path = scratch_path(spark, "bench-reference")
    fx.telemetry_reference(spark, sf_dir).write.parquet(ref_path)
    f6 = spark.read.parquet(ref_path)

    def train_reference():
        r = jobs.train(f6, REFERENCE_SPEC, PipelineConfig(train_days=EV_TRAIN_DAYS), expect={"cols": 19, "assets": 16})
        r.metrics.collect()
        rep["ref"] = r

    timed("train_full_reference_layout", train_reference)
    timed("score_detect_reference_layout", lambda: noop(jobs.detect_anomalies(f6, rep["ref"].model)))
    timed("flagship", lambda: noop(flagship(spark, sf_dir)))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_headline_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
