"""Walk-forward folds by merged moments, and CSV rows that cannot be read."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType, DoubleType

from vigil.config import EVENTS_SPEC
from vigil.operators import walkforward as wf
from vigil.registry import scratch_path
from vigil.sources.telemetry import read_with_rejects

SPEC = EVENTS_SPEC.with_(tiebreak=(), sensors=("x", "y"), context=())


def feats(spark, days=30, n=600, seed=0):
    r = np.random.default_rng(seed)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=float(d)), int(r.integers(0, 3)), None if r.random() < 0.02 else float(r.normal(d, 1 + d / 10)), 5.0,
             int(r.random() < 0.1), int(r.random() < 0.05)) for d in [0.0, *r.uniform(0, days, n)]]
    return spark.createDataFrame(rows + [(None, 1, 3.0, 5.0, 0, 0)], "timestamp timestamp_ntz, asset_id int, x double, y double, anomaly_label int, fault_code_true int"), rows


def test_merged_moments_equal_those_of_all_rows(spark):
    df, rows = feats(spark)
    moments = wf.block_moments(df, wf.time_block(df, SPEC, 10, 5), ["x", "y"])
    scalers = wf.fold_scalers(moments, ["x", "y"], 4)
    for fold, s in scalers.items():
        x = np.array([r[2] for r in rows if r[2] is not None and (r[0] - dt.datetime(2024, 1, 1)) < dt.timedelta(days=10 + 5 * fold)])
        assert np.isclose(s.mean[0], x.mean()) and np.isclose(s.scale[0], x.std()) and s.mean[1] == 5.0 and s.scale[1] == 1.0
    none = wf.Moments(np.zeros(2), np.zeros(2), np.zeros(2))
    both = none.merged(moments[-1])
    assert np.allclose(both.mean, moments[-1].mean) and np.allclose(none.merged(none).scaler(["x", "y"]).scale, 1)


def test_folds_are_scored_by_their_own_past(spark):
    df, rows = feats(spark)
    df, rows = df.filter("x IS NOT NULL"), [r for r in rows if r[2] is not None]
    got = {r["fold"]: r for r in wf.temporal_cv_metrics(df, SPEC, ["x", "y"], 10, 5, 6, 90.0).collect()}
    assert sorted(got) == [0, 1, 2, 3]  # later folds have no rows
    day = np.array([(r[0] - dt.datetime(2024, 1, 1)).total_seconds() / 86400 for r in rows])
    x, label = np.array([r[2] for r in rows]), np.array([r[4] for r in rows])
    for fold, g in got.items():
        past, now = day < 10 + 5 * fold, (day >= 10 + 5 * fold) & (day < 15 + 5 * fold)
        s = np.abs(x - x[past].mean()) / x[past].std()
        t = np.quantile(s[past], 0.9)
        flag = s[now] >= t
        assert np.isclose(g["threshold"], t) and g["tp"] == (flag & (label[now] == 1)).sum() and g["fp"] == (flag & (label[now] == 0)).sum()
    with pytest.raises(ValueError):
        wf.temporal_cv_metrics(df.limit(0).unionByName(df.limit(1)).filter("false"), SPEC, ["x"], 10, 5, 2)


SCHEMA = StructType([StructField("timestamp", TimestampNTZType(), False), StructField("asset_id", IntegerType(), False), StructField("x", DoubleType()),
                     StructField("note", StringType())])
LINES = ["note,x,asset_id,timestamp", "ok,1.5,1,2024-01-01 00:00:00", "ok,,2,2024-01-01T00:01:00.5", ",NaN,3,2024-01-01 00:02:00", "bad,one,4,2024-01-01 00:03:00",
         "bad,1.0,,2024-01-01 00:04:00", "bad,1.0,5.5x,soon", "short,1.0", "long,1.0,6,2024-01-01 00:05:00,7", '"a,b",2.5,7,2024-01-01 00:06:00']


def test_bad_rows_are_set_aside(spark, tmp_path):
    (tmp_path / "t.csv").write_text("\n".join(LINES) + "\n")
    good, rejects = read_with_rejects(spark, str(tmp_path), SCHEMA, max_share=0.9)
    assert good.schema.simpleString() == SCHEMA.simpleString()
    assert sorted((r["asset_id"], r["x"], r["note"]) for r in good.collect()) == [(1, 1.5, "ok"), (2, None, "ok"), (3, None, None), (7, 2.5, "a,b")]
    assert sorted(map(tuple, (sorted(r["columns"]) for r in rejects.collect()))) == [(), (), ("asset_id",), ("asset_id", "timestamp"), ("x",)]
    assert {r["record"] for r in rejects.collect() if not r["columns"]} == {"short,1.0", "long,1.0,6,2024-01-01 00:05:00,7"}
    with pytest.raises(ValueError, match="5 of 9"):
        read_with_rejects(spark, str(tmp_path), SCHEMA, max_share=0.5)
    with pytest.raises(KeyError):
        read_with_rejects(spark, str(tmp_path), StructType([*SCHEMA.fields, StructField("z", DoubleType())]))


def test_an_empty_file_has_no_rejects(spark, tmp_path):
    (tmp_path / "t.csv").write_text(LINES[0] + "\n")
    good, rejects = read_with_rejects(spark, str(tmp_path), SCHEMA)
    assert good.count() == 0 and rejects.count() == 0
