"""Hand-made edge cases (FIXTURES F5) against the rules applied row by row in plain Python, and evaluation corner cases against direct NumPy formulas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from vigil.config import TelemetrySpec
from vigil.operators import evaluate as ev
from vigil.operators.features import wrangle_and_features

SPEC = TelemetrySpec(tiebreak=("rid",), sensors=("a", "b"), context=("c",), ids=(), extra_labels=())
NAN = float("nan")


def edge_rows() -> list:
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    # asset 1: 60 rows, gaps of 1, 5, 6, 10, 11, 13 in sensor a; NaN next to a null in b
    gaps = {3: 1, 8: 5, 18: 6, 28: 10, 42: 11}
    a = [float(i % 7) for i in range(60)]
    for start, n in gaps.items():
        for j in range(start, start + n):
            a[j] = None
    for j in range(45, 58):
        a[j] = None if j < 56 else a[j]
    for i in range(60):
        b = NAN if i == 10 else (None if i == 11 else float(i) * 0.5)
        rows.append((1, t0 + dt.timedelta(minutes=i), i, a[i], b, 3.0))
    # asset 2: all missing; asset 3: one row; asset 4: constant; assets 5/6 interleaved
    for i in range(20):
        rows.append((2, t0 + dt.timedelta(minutes=i), 100 + i, None, None, None))
    rows.append((3, t0, 200, 4.0, 2.0, 1.0))
    for i in range(20):
        rows.append((4, t0 + dt.timedelta(minutes=i), 300 + i, 5.0, 5.0, 5.0))
    for i in range(40):
        rows.append((5 + i % 2, t0 + dt.timedelta(seconds=30 * i), 400 + i, float(i), float(-i), float(i % 3)))
    # ties in time resolved by rid
    for i in range(6):
        rows.append((7, t0 + dt.timedelta(minutes=i // 3), 500 + i, float(i), None if i == 2 else 1.0, 0.0))
    return rows


def edge_table() -> pd.DataFrame:
    return pd.DataFrame(edge_rows(), columns=["asset_id", "timestamp", "rid", "a", "b", "c"])


def is_gap(v) -> bool:
    return v is None or v != v


def filled(values: list, limit: int) -> list:
    """Each gap of a series looks ``limit`` rows back, then ``limit`` rows ahead, for a reading."""
    out = []
    for i, v in enumerate(values):
        back = next((values[j] for j in range(i, max(-1, i - limit - 1), -1) if not is_gap(values[j])), None)
        out.append(back)
    for i in range(len(values)):
        if out[i] is None:
            # what the forward pass left: the nearest row ahead that has a value after it
            ahead = next((j for j in range(i + 1, min(len(values), i + limit + 1)) if out[j] is not None), None)
            values = values[:i] + [out[ahead] if ahead is not None else None] + values[i + 1:]
    return [out[i] if out[i] is not None else (values[i] if not is_gap(values[i]) else 0.0) for i in range(len(out))]


def brute_force(pdf: pd.DataFrame, window=15, limit=5) -> pd.DataFrame:
    """The rules applied row by row to each asset's plain lists."""
    rows = sorted(pdf.itertuples(index=False), key=lambda r: (r.asset_id, r.timestamp, r.rid))
    out = []
    for asset in sorted({r.asset_id for r in rows}):
        mine = [r for r in rows if r.asset_id == asset]
        series = {c: filled([getattr(r, c) for r in mine], limit) for c in "abc"}
        for i, r in enumerate(mine):
            rec = {"asset_id": asset, "timestamp": r.timestamp, "rid": r.rid}
            for c in "abc":
                rec[c] = series[c][i]
                rec[f"{c}_was_nan"] = int(is_gap(getattr(r, c)))
            for c in "ab":
                last = series[c][max(0, i - window + 1): i + 1]
                mean = sum(last) / len(last)
                std = (sum((v - mean) ** 2 for v in last) / len(last)) ** 0.5 if len(set(last)) > 1 else 0.0
                rec[f"{c}_roll_mean"], rec[f"{c}_roll_std"] = mean, std
                rec[f"{c}_diff"] = series[c][i] - series[c][i - 1] if i else 0.0
                rec[f"{c}_zscore"] = (series[c][i] - mean) / std if std else 0.0
            out.append(rec)
    return pd.DataFrame(out)


@pytest.mark.parametrize("chunks", [False, True])
def test_edge_fixture_matches_brute_force(spark, chunks):
    from vigil.operators.wrangle import nan_to_null
    pdf = edge_table()
    df = spark.createDataFrame(edge_rows(),
                               "asset_id int, timestamp timestamp_ntz, rid int, a double, b double, c double")
    df = nan_to_null(df, ["a", "b", "c"])
    got = wrangle_and_features(df, SPEC, force_chunks=chunks, chunk_rows=25).toPandas()
    got = got.sort_values(["asset_id", "timestamp", "rid"]).reset_index(drop=True)
    exp = brute_force(pdf)
    for c in exp.columns:
        if c in ("timestamp",):
            continue
        assert np.allclose(got[c].to_numpy(float), exp[c].to_numpy(float), atol=1e-9), c


def np_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def np_ap(y, s):
    order = np.argsort(-s, kind="mergesort")
    ys, ss = y[order], s[order]
    total, ap, tp, fp = y.sum(), 0.0, 0, 0
    i = 0
    while i < len(ss):
        j = i
        while j < len(ss) and ss[j] == ss[i]:
            j += 1
        p = ys[i:j].sum()
        tp += p
        fp += (j - i) - p
        ap += p / total * tp / (tp + fp)
        i = j
    return ap


@pytest.mark.parametrize("case", ["random", "ties", "negzero", "all_equal"])
def test_rank_metrics_equal_numpy(spark, case):
    rng = np.random.default_rng(7)
    n = 400
    y = (rng.random(n) < 0.2).astype(int)
    s = rng.normal(size=n)
    if case == "ties":
        s = np.round(s, 1)
    if case == "negzero":
        s = np.where(rng.random(n) < 0.3, np.where(rng.random(n) < 0.5, -0.0, 0.0), np.round(s, 1))
    if case == "all_equal":
        s = np.ones(n)
    df = spark.createDataFrame(pd.DataFrame({"anomaly_label": y, "anomaly_score": s}))
    got = ev.rank_metrics(df).first()
    assert abs(got["roc_auc"] - np_auc(y, s)) < 1e-12
    assert abs(got["pr_auc"] - np_ap(y, s)) < 1e-12


def test_no_positive_labels_gives_null_metrics(spark):
    pdf = pd.DataFrame({"anomaly_label": [0] * 5, "anomaly_pred": [0, 1, 0, 1, 1],
                        "anomaly_score": [0.1, 0.9, 0.2, 0.8, 0.7], "fault_code_true": [0, 1, 0, 0, 2]})
    r = ev.evaluate(spark.createDataFrame(pdf)).first()
    for m in ["precision", "recall", "f1", "roc_auc", "pr_auc", "fault_code_recall"]:
        assert r[m] is None
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (2, 3, 0, 0)
    assert r["n_anomalies_predicted"] == 3


def test_all_positive_labels(spark):
    pdf = pd.DataFrame({"anomaly_label": [1] * 4, "anomaly_pred": [0, 1, 1, 1],
                        "anomaly_score": [0.1, 0.9, 0.2, 0.8], "fault_code_true": [0, 0, 0, 0]})
    r = ev.evaluate(spark.createDataFrame(pdf)).first()
    assert r["roc_auc"] is None           # one class only
    assert r["precision"] == 1.0 and r["recall"] == 0.75
    assert r["fault_code_recall"] is None


def test_histogram_constant_scores(spark):
    df = spark.createDataFrame(pd.DataFrame({"anomaly_score": [2.0] * 10}))
    h = ev.score_histogram(df, bins=80).toPandas()
    assert len(h) == 80 and h["count"].sum() == 10
    counts, edges = np.histogram(np.full(10, 2.0), bins=80)
    assert list(h.sort_values("bin")["count"]) == list(counts)


def _score_rows(spark, rows):
    return spark.createDataFrame(rows, "s double, pos long, neg long, pos_cum long, neg_cum long, pos_all long, neg_all long")


def test_auc_beyond_the_range_of_a_long(spark, monkeypatch):
    """P * N is about 1.6e19 here; half the positives lie above all negatives, half below."""
    n = 4_000_000_000
    table = _score_rows(spark, [(3.0, n // 2, 0, n // 2, 0, n, n), (2.0, 0, n, n // 2, n, n, n), (1.0, n // 2, 0, n, n, n, n)])
    monkeypatch.setattr(ev, "score_table", lambda *a, **k: table)
    row = ev.rank_metrics(table).first()
    assert abs(row["roc_auc"] - 0.5) < 1e-12


def test_evaluation_plans_have_no_nested_loops(spark):
    df = spark.range(200).selectExpr("CAST(id % 2 AS INT) AS anomaly_label", "CAST(id % 3 = 0 AS INT) AS anomaly_pred",
                                     "CAST(id % 17 AS DOUBLE) AS anomaly_score", "CAST(id % 5 = 0 AS INT) AS fault_code_true",
                                     "IF(id % 4 = 0, NULL, id % 4) AS g")
    for keys in ([], ["g"]):
        for out in (ev.rank_metrics(df, keys=keys), ev.evaluate(df, keys=keys), ev.pr_curve(df, keys=keys), ev.score_histogram(df, keys=keys)):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert ev.evaluate(df, keys=keys).count() == (4 if keys else 1)     # the null group is one of them
    assert ev.best_threshold(df).count() == 1
