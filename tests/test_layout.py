"""Physical-layout helpers: chunked windows with a halo, positional index, running totals
and order statistics give the same answers as the plain single-group forms."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from vigil.config import EVENTS_SPEC, LINEITEM_SPEC
from vigil.operators.features import TIE, total_order, wrangle_and_features
from vigil.plans.layout import POS, positional_index, running_totals
from vigil.plans.order_stats import grouped_percentiles
from vigil.sources import fixtures as fx


def _frame(df, key):
    return df.toPandas().sort_values(key).reset_index(drop=True)


@pytest.mark.parametrize("causal", [False, True])
def test_chunked_features_equal_plain(spark, causal):
    f1 = fx.telemetry_events(spark, SF_MID)
    plain = wrangle_and_features(f1, EVENTS_SPEC, causal=causal, force_chunks=False)
    chunked = wrangle_and_features(f1, EVENTS_SPEC, causal=causal, force_chunks=True, chunk_rows=25)
    a, b = _frame(plain, "event_id"), _frame(chunked, "event_id")
    assert list(a.columns) == list(b.columns)
    assert len(a) == len(b) == 10_000
    num = a.select_dtypes("number").columns
    assert np.allclose(a[num].to_numpy(float), b[num].to_numpy(float), atol=1e-9, equal_nan=True)


def test_chunked_lineitem_ties_in_time(spark):
    f2 = fx.telemetry_lineitem(spark, SF_SMALL)
    plain = wrangle_and_features(f2, LINEITEM_SPEC, force_chunks=False)
    chunked = wrangle_and_features(f2, LINEITEM_SPEC, force_chunks=True, chunk_rows=30)
    a, b = _frame(plain, ["asset_id", "rn"]), _frame(chunked, ["asset_id", "rn"])
    num = a.select_dtypes("number").columns
    assert np.allclose(a[num].to_numpy(float), b[num].to_numpy(float), atol=1e-9, equal_nan=True)


def test_ties_in_time_without_a_tiebreak(spark):
    """A spec without a tiebreak orders ties by their contents: any partitioning and layout gives the same rows."""
    rng = np.random.default_rng(3)
    rows = [(f"a{i % 3}", i // 9, int(x), float(y), i) for i, (x, y) in enumerate(zip(rng.integers(0, 50, 900), rng.normal(size=900)))]
    spec = LINEITEM_SPEC.with_(ts="ts", tiebreak=(), sensors=("x", "y"))
    table = spark.createDataFrame(rows, "asset_id string, ts int, x int, y double, nr int")
    got = []
    for parts, chunks in ((1, False), (7, False), (5, True)):
        df, ordered = total_order(table.orderBy(F.rand(parts)).repartition(parts), spec)
        assert ordered.order == ("ts", TIE)
        got.append(_frame(wrangle_and_features(df, ordered, force_chunks=chunks, chunk_rows=40), "nr"))
    num = got[0].select_dtypes("number").columns
    for other in got[1:]:
        assert np.allclose(got[0][num].to_numpy(float), other[num].to_numpy(float), atol=1e-9, equal_nan=True)
    assert total_order(table, LINEITEM_SPEC) == (table, LINEITEM_SPEC)


def test_hot_key_detection_switches_layout(spark):
    f1 = fx.telemetry_events(spark, SF_SMALL)
    auto = wrangle_and_features(f1, EVENTS_SPEC, max_series_rows=10, chunk_rows=40)
    plain = wrangle_and_features(f1, EVENTS_SPEC, force_chunks=False)
    a, b = _frame(auto, "event_id"), _frame(plain, "event_id")
    num = a.select_dtypes("number").columns
    assert np.allclose(a[num].to_numpy(float), b[num].to_numpy(float), atol=1e-9, equal_nan=True)


def test_positional_index_contiguous_under_skew(spark):
    # one key holds ~half of all rows
    df = spark.range(0, 20_000).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 7).alias("k"),
                                       (F.col("id") * 7919 % 20_000).alias("o"))
    idx = positional_index(df, ["k"], ["o"], n_parts=6).toPandas()
    for _, g in idx.groupby("k"):
        g = g.sort_values("o")
        assert list(g[POS]) == list(range(len(g)))


def test_running_totals_with_null_keys(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 3000), "s": rng.normal(size=3000).round(2), "v": rng.integers(0, 5, 3000)})
    pdf = pdf.drop_duplicates(["k", "s"])
    df = spark.createDataFrame(pdf).withColumn("k", F.when(F.col("k") > 0, F.col("k")))      # key 0 becomes null
    out = running_totals(df, [F.desc("s")], ["v"], keys=["k"], n_parts=7).toPandas()
    out["k"] = out["k"].fillna(0).astype(int)
    exp = pdf.sort_values(["k", "s"], ascending=[True, False])
    exp["v_cum"] = exp.groupby("k")["v"].cumsum()
    exp["v_all"] = exp.groupby("k")["v"].transform("sum")
    m = out.merge(exp, on=["k", "s"], suffixes=("", "_e"))
    assert len(m) == len(pdf)
    assert (m["v_cum"] == m["v_cum_e"]).all() and (m["v_all"] == m["v_all_e"]).all()


@pytest.mark.parametrize("tied", [0.0, 0.5, 0.95])
def test_percentiles_equal_numpy_with_null_group_nulls_and_ties(spark, tied):
    rng = np.random.default_rng(2)
    vals = rng.normal(size=2001)
    vals[rng.random(len(vals)) < tied] = 1.25
    vals[rng.random(len(vals)) < 0.4] = np.nan
    pdf = pd.DataFrame({"g": rng.integers(0, 4, len(vals)), "x": vals})
    df = (spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
          .withColumn("g", F.when(F.col("g") > 0, F.col("g"))))
    ps = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = grouped_percentiles(df, "x", ps, keys=["g"]).collect()
    assert len(got) == 4 * len(ps)
    for r in got:
        x = pdf.loc[pdf.g == (r["g"] or 0), "x"].dropna().to_numpy()
        assert abs(r["percentile"] - np.percentile(x, r["p"] * 100)) < 1e-12
    assert grouped_percentiles(df.filter("x IS NULL"), "x", ps).count() == 0


def test_null_asset_rows_survive_chunking(spark):
    f1 = fx.telemetry_events(spark, SF_SMALL).withColumn(
        "asset_id", F.when(F.col("asset_id") % 5 != 0, F.col("asset_id")))
    plain = wrangle_and_features(f1, EVENTS_SPEC, force_chunks=False)
    for how in ({"force_chunks": True}, {"max_series_rows": 50}):
        other = wrangle_and_features(f1, EVENTS_SPEC, chunk_rows=40, **how)
        a, b = _frame(plain, "event_id"), _frame(other, "event_id")
        assert len(a) == len(b) and a["asset_id"].isna().sum() == b["asset_id"].isna().sum() > 50
        num = a.select_dtypes("number").columns
        assert np.allclose(a[num].to_numpy(float), b[num].to_numpy(float), atol=1e-9, equal_nan=True)


def test_only_hot_assets_are_chunked(spark):
    f1 = fx.telemetry_events(spark, SF_SMALL)
    counts = sorted(r[0] for r in f1.groupBy("asset_id").count().select("count").collect())
    limit = counts[len(counts) // 2]          # about half the assets are "hot"
    mixed = wrangle_and_features(f1, EVENTS_SPEC, max_series_rows=limit, chunk_rows=30)
    plain = wrangle_and_features(f1, EVENTS_SPEC, force_chunks=False)
    a, b = _frame(mixed, "event_id"), _frame(plain, "event_id")
    assert len(a) == len(b)
    num = a.select_dtypes("number").columns
    assert np.allclose(a[num].to_numpy(float), b[num].to_numpy(float), atol=1e-9, equal_nan=True)


def test_fixture_row_numbers_with_hot_keys(spark):
    plain = fx.telemetry_events(spark, SF_SMALL).toPandas().sort_values("event_id").reset_index(drop=True)
    hot = fx.telemetry_events(spark, SF_SMALL, max_series_rows=60).toPandas().sort_values("event_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(plain, hot[plain.columns])


def test_one_asset_with_a_third_of_all_rows(spark):
    """Skew assumption: one key holds a third of all rows. The hot asset is detected, spread
    over several range partitions, and the features equal the plain per-asset windows."""
    f2 = fx.telemetry_lineitem(spark, SF_MID)
    # the original supplier id joins the tiebreak, so the merged series keeps a total order
    skewed = (f2.withColumn("rn", F.col("rn") * 100_000 + F.col("asset_id"))
              .withColumn("asset_id", F.when(F.col("asset_id") % 3 == 0, F.lit(0)).otherwise(F.col("asset_id"))))
    skewed = skewed.checkpoint(eager=True)
    sizes = dict(skewed.groupBy("asset_id").count().collect())
    assert sizes[0] * 3 >= skewed.count() * 0.9
    auto = wrangle_and_features(skewed, LINEITEM_SPEC, max_series_rows=5_000, chunk_rows=2_000)
    plain = wrangle_and_features(skewed, LINEITEM_SPEC, force_chunks=False)
    a, b = _frame(auto, ["asset_id", "timestamp", "rn"]), _frame(plain, ["asset_id", "timestamp", "rn"])
    assert len(a) == len(b) == skewed.count()
    num = a.select_dtypes("number").columns
    assert np.allclose(a[num].to_numpy(float), b[num].to_numpy(float), atol=1e-9, equal_nan=True)
    hot = skewed.filter(F.col("asset_id") == 0)
    idx = positional_index(hot, ["asset_id"], ["timestamp", "rn"], n_parts=8)
    assert idx.select(F.spark_partition_id().alias("p")).distinct().count() >= 4


def test_a_few_long_series_are_spread_over_many_tasks(spark):
    """Sixteen assets may hold a whole table: a task gets a piece of a series that takes it seconds."""
    from vigil.config import PipelineConfig
    from vigil.plans.layout import CHUNK, plan_series
    rows = spark.range(300_000).select((F.col("id") % 300_000 >= 10).cast("int").alias("asset_id"), F.col("id").alias("timestamp"))
    (short, plain), (long, layout) = plan_series(rows, "asset_id", ["timestamp"], 24, 5)
    assert short.count() == 10 and not plain.chunked and layout.chunked
    assert long.filter("_vg_home").select(CHUNK).distinct().count() == 3
    assert long.filter("_vg_home").count() == 299_990
    assert PipelineConfig().max_series_rows < 300_000
