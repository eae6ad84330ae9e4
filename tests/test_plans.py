"""Physical-plan shape of the hot paths (what the scale claims in README rest on)."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.config import EVENTS_SPEC
from vigil.operators.features import wrangle_and_features
from vigil.operators.profile import assert_contract, column_contract, input_contract
from vigil.plans import jobs
from vigil.plans.order_stats import grouped_percentiles
from vigil.registry import JOB_CONFIG, scratch_path
from vigil.sources import fixtures as fx
from vigil.sources.telemetry import read_telemetry


def plan_of(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")    # the static plan, not AQE's wrapper
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.fixture(scope="module")
def events_table(spark):
    path = scratch_path(spark, "plan-events")
    fx.telemetry_events(spark, SF_SMALL).write.parquet(path)
    return path


def test_feature_pass_is_one_shuffle_with_pushdown(spark, events_table):
    t = spark.read.parquet(events_table)
    feats = (wrangle_and_features(t, EVENTS_SPEC, force_chunks=False)
             .filter(F.col("asset_id") < 40).select("event_id", "s1_zscore", "s2_roll_std"))
    plan = plan_of(feats)
    assert len(re.findall(r"Exchange hashpartitioning\(asset_id", plan)) == 1
    assert plan.count("Exchange") == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1
    assert "PushedFilters: [IsNotNull(asset_id), LessThan(asset_id,40)]" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "load_pct" not in scan and "anomaly_label" not in scan     # column pruning


def test_scoring_adds_no_shuffle(spark, events_table):
    t = spark.read.parquet(events_table)
    rep = jobs.train(t, EVENTS_SPEC, JOB_CONFIG, key="event_id")
    scored = jobs.detect_anomalies(t, rep.model)
    assert plan_of(scored).count("Exchange") == 1          # only the per-asset series exchange


def test_chunked_plan_splits_by_asset_and_chunk(spark, events_table):
    t = spark.read.parquet(events_table)
    feats = wrangle_and_features(t, EVENTS_SPEC, force_chunks=True, chunk_rows=100)
    plan = plan_of(feats)
    assert re.search(r"Exchange hashpartitioning\(asset_id#\d+L?, _vg_chunk", plan)


def test_contract_table_and_raise(spark, events_table):
    t = spark.read.parquet(events_table)
    c = input_contract(t, EVENTS_SPEC, t.count(), len(t.columns), 15)
    assert all(r["ok"] for r in c.collect())
    with pytest.raises(ValueError):
        assert_contract(input_contract(t, EVENTS_SPEC, 230_400, 19, 16))
    column_contract(t, EVENTS_SPEC)
    with pytest.raises(KeyError):
        column_contract(t.drop("timestamp"), EVENTS_SPEC)


def test_csv_reader_maps_nan_to_null_by_name(spark):
    rows = [("2024-01-01T00:00:00.000001", 1, "NaN", "2.5"), ("2024-01-01T00:01:00.000000", 1, "1.0", "")]
    path = scratch_path(spark, "csv-nan")
    spark.createDataFrame(rows, "timestamp string, asset_id int, a string, b string").select(
        "b", "a", "asset_id", "timestamp").write.option("header", True).csv(path)
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType, TimestampNTZType
    schema = StructType([StructField("timestamp", TimestampNTZType()), StructField("asset_id", IntegerType()),
                         StructField("a", DoubleType()), StructField("b", DoubleType())])
    got = read_telemetry(spark, path, "csv", schema=schema).orderBy("timestamp").collect()
    assert got[0]["a"] is None and got[0]["b"] == 2.5 and got[1]["b"] is None
    assert got[0]["timestamp"].microsecond == 1


def test_approx_percentile_close_to_exact(spark):
    df = spark.range(0, 100_000).select((F.col("id") * 37 % 1000).cast("double").alias("x"))
    ex = grouped_percentiles(df, "x", [0.5, 0.99]).orderBy("p").collect()
    ap = grouped_percentiles(df, "x", [0.5, 0.99], approx=True).orderBy("p").collect()
    for a, b in zip(ex, ap):
        assert abs(a["percentile"] - b["percentile"]) <= 2.0


def test_ml_transformer_in_pipeline_roundtrip(spark, events_table, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from vigil.operators.transformers import TelemetryFeatures
    t = spark.read.parquet(events_table)
    stage = TelemetryFeatures.from_spec(EVENTS_SPEC)
    model = Pipeline(stages=[stage]).fit(t)
    path = str(tmp_path / "pipe")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = model.transform(t).orderBy("event_id").select("event_id", "s1_zscore").collect()
    b = back.transform(t).orderBy("event_id").select("event_id", "s1_zscore").collect()
    direct = wrangle_and_features(t, EVENTS_SPEC).orderBy("event_id").select("event_id", "s1_zscore").collect()
    assert a == b == direct


def test_split_independent_of_session_time_zone(spark, events_table):
    from vigil.operators.split import cutoff_of, with_split
    t = spark.read.parquet(events_table)

    def counts():
        cut = cutoff_of(t, EVENTS_SPEC, 21)
        return cut, sorted(tuple(r) for r in with_split(t, EVENTS_SPEC, cut).groupBy("split").count().collect())

    base = counts()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        other = counts()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert base == other
