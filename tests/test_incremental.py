"""Scoring by period, published model versions, replaceable sinks, sketches and online k-means."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.config import EVENTS_SPEC
from vigil.operators.score import CentroidModel, MixtureModel
from vigil.plans import incremental, jobs, sketches
from vigil.plans.incremental import open_rows, read_state, score_period
from vigil.registry import JOB_CONFIG, scratch_path
from vigil.session import checkpointed
from vigil.sources import fixtures as fx
from vigil.sources import store
from vigil.streaming.kmeans import read_centres, update_centres


@pytest.fixture(scope="module")
def trained(spark):
    f1 = fx.telemetry_events(spark, SF_SMALL)
    return f1, jobs.train(f1, EVENTS_SPEC, JOB_CONFIG, key="event_id")


def replayed(spark, table, model, periods, **kw):
    state, out = scratch_path(spark, "t-state"), scratch_path(spark, "t-runs")
    for p in periods:
        score_period(table, "part", p, model, state, out, **kw)
    return state, out


def cells(df):
    return {r["event_id"]: (None if r["anomaly_score"] is None else round(r["anomaly_score"], 9), r["anomaly_pred"]) for r in df.collect()}


@pytest.mark.parametrize("causal", [False, True])
@pytest.mark.parametrize("kw", [{}, {"force_chunks": True, "chunk_rows": 60}])
def test_periods_equal_the_whole_table(spark, trained, causal, kw):
    f1, report = trained
    model = jobs.DetectorModel(**{**report.model.__dict__, "config": report.model.config.with_(causal_fill=causal)})
    # Uneven periods: some hold a row or two of an asset, less than the look-ahead; null is an asset, too.
    rows = f1.withColumn("asset_id", F.when(F.col("asset_id") % 7 != 3, F.col("asset_id") % 12))
    day = F.dayofyear("timestamp") - F.lit(f1.agg(F.min(F.dayofyear("timestamp"))).first()[0])
    path = scratch_path(spark, "t-src")
    rows.withColumn("part", F.format_string("%03d", F.when(day < 12, F.lit(0)).when(day < 13, F.lit(1)).otherwise(day / 9 + 2).cast("int"))
                    ).write.partitionBy("part").parquet(path)
    table = spark.read.parquet(path)
    table = table.withColumn("part", F.format_string("%03d", F.col("part").cast("int")))
    periods = sorted(r[0] for r in table.select("part").distinct().collect())
    assert len(periods) > 3
    state, out = replayed(spark, table, model, periods, **kw)
    got = cells(spark.read.parquet(out))
    rest = cells(open_rows(spark, model, state))
    assert not set(got) & set(rest) and bool(rest) == (not causal)
    assert {**got, **rest} == cells(jobs.detect_anomalies(rows, model))
    # The last period again, as after a failure.
    score_period(table, "part", periods[-1], model, state, out, **kw)
    assert cells(spark.read.parquet(out)) == got and cells(open_rows(spark, model, state)) == rest
    back = 19 + (0 if causal else 5)
    assert read_state(spark, state).groupBy("asset_id").count().agg(F.max("count")).first()[0] <= back


def test_late_rows_stay_and_are_not_scored(spark, trained):
    f1, report = trained
    one = f1.filter("asset_id % 5 = 0").withColumn("part", F.when(F.dayofyear("timestamp") % 2 == 0, "a").otherwise("b"))
    first = one.filter("part = 'a'").groupBy("asset_id").agg(F.max(F.struct("timestamp", "event_id")).alias("last"))
    late = {r["event_id"] for r in one.filter("part = 'b'").join(first, "asset_id").filter(F.struct("timestamp", "event_id") <= F.col("last")).collect()}
    _, out = replayed(spark, one, report.model, ["a", "b"])
    got = cells(spark.read.parquet(out).filter("run = 'b'"))
    assert late and {e for e, v in got.items() if v == (None, None)} == late


def test_a_later_period_is_written_once(spark, trained, monkeypatch):
    f1, report = trained
    rows = f1.filter("asset_id % 5 = 0")
    written = []
    monkeypatch.setattr(incremental, "checkpointed", lambda df: written.append(df.columns) or checkpointed(df))
    table = rows.withColumn("part", F.when(F.dayofyear("timestamp") < 12, "a").otherwise("b"))
    state, out = replayed(spark, table, report.model, ["a", "b"])
    assert len(written) == 2  # one copy a period, with marks and scores
    assert {**cells(spark.read.parquet(out)), **cells(open_rows(spark, report.model, state))} == cells(jobs.detect_anomalies(rows, report.model))
    # One row as early as the state's last one: late rows are looked for by asset.
    last = read_state(spark, state).orderBy(F.desc("timestamp"), F.desc("event_id")).limit(1).select(*rows.columns)
    again = last.withColumn("part", F.lit("c"))
    score_period(again, "part", "c", report.model, state, out)
    assert len(written) == 4 and cells(spark.read.parquet(out).filter("run = 'c'")) == {last.first()["event_id"]: (None, None)}


def test_a_run_reads_one_partition(spark, trained):
    f1, _ = trained
    path = scratch_path(spark, "t-pruned")
    f1.withColumn("part", F.dayofyear("timestamp") % 3).write.partitionBy("part").parquet(path)
    plan = spark.read.parquet(path).filter(F.col("part") == "1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "PushedFilters: []" in plan


def test_readers_see_whole_published_models(spark, trained, monkeypatch):
    _, report = trained
    path = scratch_path(spark, "t-model")
    with pytest.raises(FileNotFoundError):
        store.load_model(spark, path)
    first = store.save_model(spark, report.model, path)
    other = jobs.DetectorModel(**{**report.model.__dict__, "threshold": 123.0})
    with monkeypatch.context() as m:  # stops after the version's files, before it is published
        m.setattr(store, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            store.save_model(spark, other, path)
    assert store.load_model(spark, path) == report.model and store.model_versions(spark, path) == [first]
    second = store.save_model(spark, other, path)
    assert store.load_model(spark, path).threshold == 123.0
    assert store.load_model(spark, path, first) == report.model and store.model_versions(spark, path) == [first, second]
    with pytest.raises(FileNotFoundError):
        store.load_model(spark, path, "nothing")


def test_model_keeps_ridge_and_extra_settings(spark, trained):
    _, report = trained
    cols = report.model.features[:2]
    mixture = MixtureModel(tuple(cols), (0.25, 0.75), ((0.0, 1.0), (2.0, 3.0)), (((1.0, 0.1), (0.1, 2.0)),) * 2, ridge=0.5)
    model = jobs.DetectorModel(**{**report.model.__dict__, "clusterer": mixture, "config": report.model.config.with_(extra={"lloyd_steps": 9})})
    path = scratch_path(spark, "t-mixture")
    store.save_model(spark, model, path)
    assert store.load_model(spark, path) == model


def test_days_are_replaced_one_by_one(spark):
    path = scratch_path(spark, "t-sink")
    day = lambda d, v, split="train": spark.createDataFrame([(i, dt.datetime(2024, 1, d, i), split, v) for i in range(20)],
                                                            "id long, timestamp timestamp_ntz, split string, v int").repartition(7)
    for args in ((1, 1), (2, 2), (1, 3), (2, 2), (2, 4, "test")):
        store.write_scored(day(*args), path, "timestamp")
    got = spark.read.parquet(path).groupBy("split", "date", "v").count().collect()
    assert sorted((r["split"], r["date"].day, r["v"], r["count"]) for r in got) == [("test", 2, 4, 20), ("train", 1, 3, 20), ("train", 2, 2, 20)]
    assert len(spark.read.parquet(path).inputFiles()) <= 6


def test_sketch_thresholds_lie_within_their_bound(spark):
    r = random.Random(3)
    rows = [(i % 3, dt.datetime(2024, 1, 1 + i % 5), None if i % 50 == 7 else r.lognormvariate(0, 2)) for i in range(60_000)]
    df = spark.createDataFrame(rows, "a int, timestamp timestamp_ntz, anomaly_score double")
    path = scratch_path(spark, "t-sketch")
    for d in (0, 1, 2, 3, 4, 2):  # a day again
        sketches.write_sketches(df.filter(F.dayofmonth("timestamp") == 1 + d), path, "timestamp", ["a"], k=400)
    error = 2 * sketches.rank_error(400)
    every = np.array([x[2] for x in rows if x[2] is not None])
    for keys, first, last, mask in (([], None, None, lambda x: True), (["a"], None, None, lambda x: True),
                                    (["a"], "2024-01-02", "2024-01-03", lambda x: x[1].day in (2, 3))):
        for t in sketches.sketch_thresholds(spark, path, 90.0, keys, first, last).collect():
            own = np.array([x[2] for x in rows if x[2] is not None and mask(x) and (not keys or x[0] == t["a"])])
            assert t["n"] == len(own)
            assert (own < t["threshold"]).mean() - error <= 0.9 <= (own <= t["threshold"]).mean() + error
    assert sketches.sketch_thresholds(spark, path).first()["n"] == len(every)


def test_online_centres_are_running_means_and_replays_change_nothing(spark):
    r = np.random.default_rng(0)
    x = np.concatenate((r.normal(0, 1, (40, 2)), r.normal(8, 1, (50, 2))))
    r.shuffle(x)
    start = CentroidModel(("x", "y"), ((0.0, 1.0), (9.0, 9.0), (1e6, 1e6)))
    state = scratch_path(spark, "t-kmeans")
    assert read_centres(spark, state, ["x", "y"]) is None
    c, n = np.array(start.centres), np.zeros(3)
    for batch, part in enumerate(np.split(x, 3)):
        df = spark.createDataFrame([tuple(map(float, p)) for p in part] + [(None, 1.0)], "x double, y double")
        near = ((part[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        for i in np.unique(near):
            m = (near == i).sum()
            c[i] = (n[i] * c[i] + part[near == i].sum(axis=0)) / (n[i] + m)
            n[i] += m
        for _ in range(2):  # the batch, and its replay
            update_centres(df, batch, start, state)
            model, seen = read_centres(spark, state, ["x", "y"])
            assert np.allclose(model.centres, c) and seen == n.tolist()
    update_centres(df.limit(0), 3, start, state)
    assert read_centres(spark, state, ["x", "y"])[1] == n.tolist()
