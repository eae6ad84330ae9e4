"""Train and score jobs for ``spark-submit``.

    spark-submit --py-files vigil.zip -m vigil.job train  INPUT OUT [--quick] [--use-pca] [--threshold-percentile P]
    spark-submit --py-files vigil.zip -m vigil.job score  INPUT OUT --model DIR [--only-anomalies]
    spark-submit --py-files vigil.zip -m vigil.job period INPUT OUT --model DIR --state DIR --period-column C --period P

``train`` writes the model, the metrics and the scored rows (by split and day); ``period`` scores one new partition of
a table that grows, from the tail rows that the run before left in the state folder.

INPUT is a Parquet or CSV telemetry table in the reference layout, OUT a folder that all executors
reach. On a cluster the session names its shared folder in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from vigil.config import REFERENCE_SPEC, PipelineConfig
from vigil.operators.profile import assert_contract, input_contract
from vigil.operators.score import PRED, SCORE
from vigil.operators.split import SPLIT
from vigil.plans import jobs
from vigil.plans.incremental import score_period
from vigil.session import ensure_checkpoint_dir
from vigil.sources.store import load_model, write_scored
from vigil.sources.telemetry import read_telemetry


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="vigil.job")
    p.add_argument("mode", choices=("train", "score", "period"))
    p.add_argument("input")
    p.add_argument("out")
    p.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    p.add_argument("--quick", action="store_true", help="fixed K instead of the silhouette search")
    p.add_argument("--use-pca", action="store_true")
    p.add_argument("--threshold-percentile", type=float, default=PipelineConfig().threshold_percentile)
    p.add_argument("--train-days", type=int, default=PipelineConfig().train_days)
    p.add_argument("--expect-rows", type=int, help="fail unless the table has so many rows")
    p.add_argument("--model", help="model folder of an earlier train run (score, period)")
    p.add_argument("--model-version", help="a published version other than the newest")
    p.add_argument("--state", help="tail-state folder (period)")
    p.add_argument("--period-column", default="date", help="partition column of INPUT (period)")
    p.add_argument("--period", help="the partition to score (period)")
    p.add_argument("--only-anomalies", action="store_true")
    return p.parse_args(argv)


def run(spark: SparkSession, a: argparse.Namespace, spec=REFERENCE_SPEC) -> None:
    """Read, check the contract (keys present, row count if one is expected), run, write."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    if a.mode == "period":
        if not (a.model and a.state and a.period):
            raise SystemExit("period needs --model, --state and --period")
        table = spark.read.parquet(a.input)
        score_period(table, a.period_column, a.period, load_model(spark, a.model, a.model_version), a.state, a.out)
        return
    df = read_telemetry(spark, a.input, a.format)
    assert_contract(input_contract(df, spec, a.expect_rows, None, None))
    if a.mode == "train":
        config = PipelineConfig(use_pca=a.use_pca, threshold_percentile=a.threshold_percentile, train_days=a.train_days)
        report = jobs.train(df, spec, config, quick=a.quick, out_dir=a.out)
        keep = dict.fromkeys([spec.asset, *spec.order, *[c for c in spec.label_columns if c in df.columns], "cluster", SPLIT, SCORE, PRED])
        write_scored(report.scored.select(*keep), f"{a.out}/scored", spec.ts)
        return
    if not a.model:
        raise SystemExit("score needs --model")
    scored = jobs.detect_anomalies(df, load_model(spark, a.model, a.model_version), return_only_anomalies=a.only_anomalies)
    scored.write.mode("overwrite").parquet(a.out)


if __name__ == "__main__":
    session = SparkSession.builder.appName("vigil").getOrCreate()
    try:
        run(session, arguments())
    finally:
        session.stop()
