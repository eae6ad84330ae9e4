"""DuckDB SQL twin of every registered query (same keys as ``vigil.registry.QUERIES``)."""

from __future__ import annotations

from vigil import oracle as o
from vigil.config import EVENTS_SPEC, LINEITEM_SPEC

EV = EVENTS_SPEC
LI = LINEITEM_SPEC
SQL: dict[str, str] = {}

F1_DOUBLES = ["load_pct", "s1", "s2", "s3"]
F1_OTHERS = ["event_id", "asset_id", "timestamp", "regime", "fault_code_true", "anomaly_label"]
F2_DOUBLES = ["s1", "s2", "s3", "s4"]
F2_OTHERS = ["asset_id", "timestamp", "rn", "regime"]


def out(src: str, others, doubles) -> str:
    cols = list(others) + [o.r6(d, d) for d in doubles]
    return f"SELECT {', '.join(cols)} FROM ({src}) q"


def flags(spec):
    return [f"{c}_was_nan" for c in spec.fill_columns]


# --- flagship ------------------------------------------------------------------------

def scored_ctes(k: int = 3, steps: int = 5, p: float = 0.99, causal: bool = False) -> list[str]:
    """CTEs ending in ``scored`` (F1 columns + split, cluster, anomaly_score, anomaly_pred)."""
    feats = o.feature_list(EV)
    fl = ", ".join(feats)
    ctes = [
        f"feats AS ({o.split_sql(o.events_features_sql(causal=causal), EV, 21)})",
        f"scaled AS ({o.scaled_sql('SELECT * FROM feats', feats)})",
        "allpts AS (SELECT row_number() OVER (ORDER BY event_id) AS _rid, * FROM scaled)",
        f"pts AS (SELECT _rid, event_id, {fl} FROM allpts WHERE split = 'train')",
        "centres0 AS (SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS INTEGER) AS cid, "
        + ", ".join(f"{c} AS c_{c}" for c in feats)
        + f" FROM (SELECT * FROM pts ORDER BY event_id LIMIT {k}) z)",
    ]
    lloyd, final = o.lloyd_sql("pts", "centres0", feats, k, steps)
    ctes += lloyd
    ctes += [
        f"near AS ({o.nearest_sql('allpts', final, feats)})",
        "dist AS (SELECT a.event_id, a.asset_id, a.timestamp, a.split, a.regime, a.anomaly_label, "
        "a.fault_code_true, n.cid AS cluster, sqrt(n.d2) AS anomaly_score FROM allpts a JOIN near n USING (_rid))",
        f"thr AS (SELECT quantile_cont(anomaly_score, {p}) AS t FROM dist WHERE split = 'train')",
        "scored AS (SELECT dist.*, CAST(anomaly_score >= t AS INT) AS anomaly_pred FROM dist, thr)",
    ]
    return ctes


def _flagship(k: int = 3, steps: int = 5, p: float = 0.99, causal: bool = False) -> str:
    return ("WITH " + ",\n".join(scored_ctes(k, steps, p, causal)) + "\nSELECT event_id, asset_id, timestamp, split, "
            "round(anomaly_score, 6) + 0.0 AS anomaly_score, anomaly_pred FROM scored")


SQL["detect_anomalies"] = _flagship()

# --- sources ---------------------------------------------------------------------------
SQL["telemetry_source"] = out(o.F1_SQL, F1_OTHERS, F1_DOUBLES)
SQL["telemetry_lineitem"] = out(o.F2_SQL, F2_OTHERS, F2_DOUBLES)

# --- wrangling -------------------------------------------------------------------------
SQL["missing_flags"] = out(f"SELECT *, {', '.join(f'CAST({c} IS NULL AS INT) AS {c}_was_nan' for c in EV.fill_columns)} "
                           f"FROM ({o.F1_SQL}) f", F1_OTHERS + flags(EV), F1_DOUBLES)


def _ffill_only():
    cols = EV.fill_columns
    ff = ", ".join(f"last_value({c} IGNORE NULLS) OVER {o.win(EV, '5 PRECEDING AND CURRENT ROW')} AS {c}" for c in cols)
    return f"SELECT * EXCLUDE ({', '.join(cols)}), {ff} FROM ({o.F1_SQL}) f"


SQL["ffill_limited"] = out(_ffill_only(), F1_OTHERS, F1_DOUBLES)
SQL["bfill_limited"] = out(o.filled_sql(o.F1_SQL, EV, sentinel=False, flags=False), F1_OTHERS, F1_DOUBLES)
SQL["zero_sentinel"] = out(
    f"SELECT * EXCLUDE ({', '.join(EV.fill_columns)}), "
    + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in EV.fill_columns) + f" FROM ({o.F1_SQL}) f",
    F1_OTHERS, F1_DOUBLES)
SQL["wrangle"] = out(o.filled_sql(o.F1_SQL, EV), F1_OTHERS + flags(EV), F1_DOUBLES)
SQL["wrangle_lineitem"] = out(o.filled_sql(o.F2_SQL, LI), F2_OTHERS + flags(LI), F2_DOUBLES)


def _residual():
    cols = EV.fill_columns
    filled = o.filled_sql(f"SELECT *, {', '.join(f'{c} AS _raw_{c}' for c in cols)} FROM ({o.F1_SQL}) f",
                          EV, sentinel=False, flags=False)
    parts = [f"SELECT '{c}' AS column_name, CAST(sum(CAST(_raw_{c} IS NULL AS INT)) AS BIGINT) AS missing_before, "
             f"CAST(sum(CAST({c} IS NULL AS INT)) AS BIGINT) AS missing_after FROM ({filled}) q" for c in cols]
    return " UNION ALL ".join(parts)


SQL["residual_missing"] = _residual()

# --- features --------------------------------------------------------------------------
_filled_ev = o.filled_sql(o.F1_SQL, EV)


def _rolling(std: bool):
    w = o.win(EV, "14 PRECEDING AND CURRENT ROW")
    if std:
        parts = [f"coalesce(CASE WHEN max({s}) OVER {w} = min({s}) OVER {w} THEN 0.0 ELSE stddev_pop({s}) OVER {w} END, 0.0) "
                 f"AS {s}_roll_std" for s in EV.sensors]
        names = [f"{s}_roll_std" for s in EV.sensors]
    else:
        parts = [f"avg({s}) OVER {w} AS {s}_roll_mean" for s in EV.sensors]
        names = [f"{s}_roll_mean" for s in EV.sensors]
    return out(f"SELECT *, {', '.join(parts)} FROM ({_filled_ev}) f", F1_OTHERS + flags(EV), F1_DOUBLES + names)


SQL["rolling_mean"] = _rolling(False)
SQL["rolling_std"] = _rolling(True)
SQL["first_diff"] = out(
    f"SELECT *, {', '.join(f'coalesce({s} - lag({s}) OVER {o.win(EV)}, 0.0) AS {s}_diff' for s in EV.sensors)} "
    f"FROM ({_filled_ev}) f", F1_OTHERS + flags(EV), F1_DOUBLES + [f"{s}_diff" for s in EV.sensors])
SQL["ts_features"] = out(o.events_features_sql(), F1_OTHERS + flags(EV), F1_DOUBLES + o.derived_sql(EV))
SQL["ts_features_lineitem"] = out(o.features_sql(o.filled_sql(o.F2_SQL, LI), LI), F2_OTHERS + flags(LI),
                                  F2_DOUBLES + o.derived_sql(LI))

# --- split, projections, predicates ----------------------------------------------------
F1S = o.split_sql(o.F1_SQL, EV, 21)


def eval_sql(rounded: bool = True) -> str:
    s = "round(coalesce(s1, 0.0), 0)" if rounded else "coalesce(s1, 0.0)"
    return (f"SELECT event_id, asset_id, timestamp, regime, split, {s} AS anomaly_score, anomaly_label, "
            f"fault_code_true, CASE WHEN coalesce(s1, 0.0) >= 150 THEN 1 ELSE 0 END AS anomaly_pred FROM ({F1S}) f")


EVAL_OTHERS = ["event_id", "asset_id", "timestamp", "regime", "split", "anomaly_label", "fault_code_true", "anomaly_pred"]
E_R = eval_sql(True)
E_RAW = eval_sql(False)

SQL["time_split"] = out(F1S, F1_OTHERS + ["split"], F1_DOUBLES)
SQL["split_summary"] = (f"SELECT split, count(*) AS n_rows, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) + 0.0 "
                        f"AS pct_rows, count(DISTINCT asset_id) AS n_assets FROM ({F1S}) f GROUP BY split")
SQL["select_features"] = out(o.events_features_sql(), ["event_id"], o.feature_list(EV))
SQL["threshold_predict"] = (f"WITH e AS ({E_RAW}), t AS (SELECT quantile_cont(anomaly_score, 0.99) AS t FROM e) "
                            "SELECT event_id, round(anomaly_score, 6) + 0.0 AS anomaly_score, "
                            "CAST(anomaly_score >= t AS INTEGER) AS pred_p99 FROM e, t")
SQL["only_anomalies"] = out(f"SELECT * FROM ({E_R}) e WHERE anomaly_pred = 1", EVAL_OTHERS, ["anomaly_score"])
SQL["asset_slice"] = out(f"SELECT *, CAST(anomaly_label = 1 AS INTEGER) AS is_labelled FROM ({o.F1_SQL}) f "
                         f"WHERE asset_id = (SELECT min(asset_id) FROM ({o.F1_SQL}) g)",
                         F1_OTHERS + ["is_labelled"], F1_DOUBLES)
SQL["asset_time_order"] = out(o.F1_SQL, F1_OTHERS, F1_DOUBLES)
SQL["preview"] = out(f"SELECT * FROM ({o.F1_SQL}) f ORDER BY asset_id, timestamp, event_id LIMIT 20",
                     F1_OTHERS, F1_DOUBLES)
SQL["seeded_sample"] = out(f"SELECT * FROM ({o.F1_SQL}) f ORDER BY md5('42:' || CAST(event_id AS VARCHAR)), "
                           "event_id LIMIT 100", F1_OTHERS, F1_DOUBLES)
SQL["top_anomalies"] = out(f"SELECT * FROM ({E_RAW}) e ORDER BY anomaly_score DESC, event_id LIMIT 20",
                           EVAL_OTHERS, ["anomaly_score"])

# --- profiling -------------------------------------------------------------------------
SQL["period_summary"] = (f"SELECT count(*) AS n_rows, CAST(10 AS INTEGER) AS n_cols, min(timestamp) AS ts_min, "
                         f"max(timestamp) AS ts_max, count(DISTINCT asset_id) AS n_assets, "
                         f"count(DISTINCT regime) AS n_regimes FROM ({o.F1_SQL}) f")
SQL["input_contract"] = f"""WITH a AS (SELECT count(*) AS r, count(DISTINCT asset_id) AS k,
  CAST(sum(CASE WHEN asset_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nk FROM ({o.F1_SQL}) f)
SELECT 'rows' AS "check", CAST(230400 AS BIGINT) AS expected, r AS actual, r = 230400 AS ok FROM a
UNION ALL SELECT 'columns', CAST(19 AS BIGINT), CAST(10 AS BIGINT), false FROM a
UNION ALL SELECT 'assets', CAST(16 AS BIGINT), k, k = 16 FROM a
UNION ALL SELECT 'null_asset_ids', CAST(0 AS BIGINT), nk, nk = 0 FROM a"""
SQL["missing_profile"] = ("SELECT column_name, round(frac * 100.0, 6) + 0.0 AS pct_missing FROM ("
                          + " UNION ALL ".join(f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) "
                                               f"AS frac FROM ({o.F1_SQL}) f" for c in EV.fill_columns)
                          + ") m WHERE frac > 0")
SQL["asset_coverage"] = f"""WITH per AS (SELECT asset_id, count(*) AS n FROM ({o.F1_SQL}) f GROUP BY asset_id)
SELECT count(*) AS n_assets, round(avg(n), 6) + 0.0 AS mean, round(stddev_samp(n), 6) + 0.0 AS std,
  CAST(min(n) AS BIGINT) AS min, CAST(max(n) AS BIGINT) AS max,
  CAST(sum(CASE WHEN n <> 14400 THEN 1 ELSE 0 END) AS BIGINT) AS n_off_expected,
  round(quantile_cont(n, 0.25), 6) + 0.0 AS p25, round(quantile_cont(n, 0.5), 6) + 0.0 AS p50,
  round(quantile_cont(n, 0.75), 6) + 0.0 AS p75 FROM per"""
SQL["value_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS variable, CAST({expr} AS VARCHAR) AS value, count(*) AS n FROM ({o.F1_SQL}) f "
    f"GROUP BY CAST({expr} AS VARCHAR)"
    for name, expr in [("regime", "regime"), ("anomaly_label", "anomaly_label"), ("fault", "fault_code_true <> 0")])
SQL["prevalence"] = (f"SELECT split, count(*) AS n_rows, round(avg(CAST(anomaly_label AS DOUBLE)), 6) + 0.0 AS label_rate, "
                     f"round(avg(CASE WHEN fault_code_true <> 0 THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS fault_rate "
                     f"FROM ({F1S}) f GROUP BY split")
SQL["score_percentile"] = " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(anomaly_score, {p}), 6) + 0.0 AS percentile FROM ({E_R}) e"
    for p in (0.5, 0.9, 0.99))
SQL["score_summary"] = (f"SELECT round(min(anomaly_score), 6) + 0.0 AS score_min, "
                        f"round(quantile_cont(anomaly_score, 0.5), 6) + 0.0 AS score_p50, "
                        f"round(quantile_cont(anomaly_score, 0.9), 6) + 0.0 AS score_p90, "
                        f"round(max(anomaly_score), 6) + 0.0 AS score_max, "
                        f"round(quantile_cont(anomaly_score, 0.99), 6) + 0.0 AS threshold "
                        f"FROM ({E_RAW}) e WHERE split = 'train'")
_SC = "WITH " + ",\n".join(scored_ctes()) + "\n"
SQL["cluster_regime_crosstab"] = (_SC + "SELECT cluster, regime, count(*) AS n, round(round(count(*) * 100.0 / "
                                  "sum(count(*)) OVER (PARTITION BY cluster), 1), 6) + 0.0 AS pct_row "
                                  "FROM scored GROUP BY cluster, regime")
SQL["anomaly_map"] = (_SC + "SELECT asset_id, date_trunc('hour', timestamp) AS bucket, max(anomaly_pred) AS max_pred, "
                      "count(*) AS n_rows FROM scored GROUP BY asset_id, date_trunc('hour', timestamp)")

# --- evaluation --------------------------------------------------------------------------


def conf_cols() -> str:
    return ("CAST(sum(CASE WHEN anomaly_label = 0 AND anomaly_pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn, "
            "CAST(sum(CASE WHEN anomaly_label = 0 AND anomaly_pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
            "CAST(sum(CASE WHEN anomaly_label = 1 AND anomaly_pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
            "CAST(sum(CASE WHEN anomaly_label = 1 AND anomaly_pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp")


def ratio(n: str, d: str) -> str:
    return f"CASE WHEN ({d}) = 0 THEN 0.0 ELSE CAST({n} AS DOUBLE) / ({d}) END"


def rank_sql(src: str, keys: list[str]) -> str:
    """(keys, roc_auc, pr_auc): AUC from average ranks, AP from descending cumulative counts."""
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    part = f"PARTITION BY {k}" if keys else ""
    return f"""SELECT {kc}CASE WHEN max(P) > 0 AND max(N) > 0 THEN (sum(pos * avg_rank) - max(P) * (max(P) + 1) / 2.0)
                    / (max(P) * max(N)) END AS roc_auc,
       CASE WHEN max(P) > 0 THEN sum(pos * cum_tp / (cum_tp + cum_fp)) / max(P) END AS pr_auc
FROM (SELECT *, sum(cnt) OVER ({part} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cnt
                 + (cnt + 1) / 2.0 AS avg_rank,
             sum(pos) OVER ({part} ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_tp,
             sum(cnt - pos) OVER ({part} ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_fp,
             sum(pos) OVER ({part}) AS P, sum(cnt - pos) OVER ({part}) AS N
      FROM (SELECT {kc}anomaly_score + 0.0 AS s, count(*) AS cnt,
                   sum(CASE WHEN anomaly_label = 1 THEN 1 ELSE 0 END) AS pos
            FROM ({src}) e GROUP BY {kc}anomaly_score + 0.0) g) r
{('GROUP BY ' + k) if keys else ''}"""


def evaluate_sql(src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    base = (f"SELECT {kc}{conf_cols()}, avg(CASE WHEN fault_code_true <> 0 THEN CAST(anomaly_pred AS DOUBLE) END) AS fr "
            f"FROM ({src}) e {('GROUP BY ' + k) if keys else ''}")
    join = f"JOIN ({rank_sql(src, keys)}) r USING ({k})" if keys else f", ({rank_sql(src, keys)}) r"
    g = "tp + fn > 0"
    cols = [
        f"CASE WHEN {g} THEN {ratio('tp', 'tp + fp')} END", f"CASE WHEN {g} THEN {ratio('tp', 'tp + fn')} END",
        f"CASE WHEN {g} THEN {ratio('2 * tp', '2 * tp + fp + fn')} END", f"CASE WHEN {g} THEN roc_auc END",
        f"CASE WHEN {g} THEN pr_auc END"]
    names = ["precision", "recall", "f1", "roc_auc", "pr_auc"]
    sel = ", ".join(o.r6(c, n) for c, n in zip(cols, names))
    return (f"SELECT {kc}{sel}, tp + fp AS n_anomalies_predicted, tp + fn AS n_anomalies_true, "
            f"{o.r6(f'CASE WHEN {g} THEN fr END', 'fault_code_recall')}, tn, fp, fn, tp "
            f"FROM ({base}) b {join}")


SQL["confusion_matrix"] = f"SELECT {conf_cols()} FROM ({E_R}) e"
SQL["precision_recall_f1"] = (f"SELECT {o.r6(ratio('tp', 'tp + fp'), 'precision')}, {o.r6(ratio('tp', 'tp + fn'), 'recall')}, "
                              f"{o.r6(ratio('2 * tp', '2 * tp + fp + fn'), 'f1')} FROM (SELECT {conf_cols()} FROM ({E_R}) e) c")
SQL["roc_auc"] = f"SELECT {o.r6('roc_auc', 'roc_auc')} FROM ({rank_sql(E_R, [])}) r"
SQL["average_precision"] = f"SELECT {o.r6('pr_auc', 'pr_auc')} FROM ({rank_sql(E_R, [])}) r"
SQL["roc_auc_unrounded"] = f"SELECT {o.r6('roc_auc', 'roc_auc')}, {o.r6('pr_auc', 'pr_auc')} FROM ({rank_sql(E_RAW, [])}) r"
SQL["fault_recall"] = (f"SELECT {o.r6('avg(CASE WHEN fault_code_true <> 0 THEN CAST(anomaly_pred AS DOUBLE) END)', 'fault_code_recall')} "
                       f"FROM ({E_R}) e")
SQL["pr_curve"] = f"""WITH g AS (SELECT anomaly_score + 0.0 AS s, sum(CASE WHEN anomaly_label = 1 THEN 1 ELSE 0 END) AS pos,
     sum(CASE WHEN anomaly_label = 1 THEN 0 ELSE 1 END) AS neg FROM ({E_R}) e GROUP BY anomaly_score + 0.0),
c AS (SELECT s, sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
      sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
      sum(pos) OVER () AS P FROM g)
SELECT {o.r6('s', 'threshold')}, {o.r6('tp / (tp + fp)', 'precision')},
       {o.r6('CASE WHEN P > 0 THEN tp / P ELSE 1.0 END', 'recall')} FROM c
UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0"""
SQL["score_histogram"] = f"""WITH e AS ({E_R}),
st AS (SELECT split, count(anomaly_score + 0.0) AS n,
  CASE WHEN max(anomaly_score + 0.0) > min(anomaly_score + 0.0) THEN min(anomaly_score + 0.0) ELSE min(anomaly_score + 0.0) - 0.5 END AS lo,
  CASE WHEN max(anomaly_score + 0.0) > min(anomaly_score + 0.0) THEN max(anomaly_score + 0.0) ELSE max(anomaly_score + 0.0) + 0.5 END AS hi
  FROM e GROUP BY split),
cnt AS (SELECT e.split, CAST(least(floor((e.anomaly_score + 0.0 - st.lo) * 80 / (st.hi - st.lo)), 79) AS INTEGER) AS bin,
        count(*) AS c FROM e JOIN st USING (split) GROUP BY ALL),
grid AS (SELECT st.*, CAST(b.range AS INTEGER) AS bin FROM st, range(80) b)
SELECT grid.split, grid.bin, {o.r6('lo + bin * ((hi - lo) / 80)', 'bin_lo')}, {o.r6('lo + (bin + 1) * ((hi - lo) / 80)', 'bin_hi')},
  CAST(coalesce(c, 0) AS BIGINT) AS count, {o.r6('coalesce(c, 0) / (n * ((hi - lo) / 80))', 'density')}
FROM grid LEFT JOIN cnt USING (split, bin)"""
SQL["evaluate"] = evaluate_sql(E_R, [])
SQL["metrics_by_split"] = evaluate_sql(E_R, ["split"])
SQL["metrics_by_regime"] = evaluate_sql(E_R, ["regime"])

SWEEP = (90.0, 95.0, 97.5, 99.0, 99.5)
SQL["threshold_sweep"] = f"""WITH e AS ({E_RAW}),
t AS ({" UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS percentile, quantile_cont(anomaly_score, {p / 100}) AS threshold FROM e" for p in SWEEP)}),
c AS (SELECT percentile, threshold,
  sum(CASE WHEN anomaly_score >= threshold AND anomaly_label = 1 THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN anomaly_score >= threshold AND anomaly_label <> 1 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN anomaly_score < threshold AND anomaly_label = 1 THEN 1 ELSE 0 END) AS fn FROM t, e GROUP BY ALL)
SELECT {o.r6('percentile', 'percentile')}, {o.r6('threshold', 'threshold')}, {o.r6(ratio('tp', 'tp + fp'), 'precision')},
  {o.r6(ratio('tp', 'tp + fn'), 'recall')}, {o.r6(ratio('2 * tp', '2 * tp + fp + fn'), 'f1')}, CAST(tp + fp AS BIGINT) AS n_pred FROM c"""
SQL["threshold_3sigma"] = f"""WITH e AS ({E_RAW}),
t AS (SELECT avg(anomaly_score) + 3.0 * stddev_pop(anomaly_score) AS t FROM e WHERE split = 'train')
SELECT split, {o.r6('max(t)', 'threshold')}, CAST(sum(CASE WHEN anomaly_score >= t THEN 1 ELSE 0 END) AS BIGINT) AS n_pred
FROM e, t GROUP BY split"""


def best_sql(objective: str) -> str:
    val = (ratio("2 * tp", "2 * tp + fp + fn") if objective == "f1"
           else "CAST(1.0 AS DOUBLE) * fp + CAST(10.0 AS DOUBLE) * fn")
    order = "value DESC, threshold DESC" if objective == "f1" else "value ASC, threshold DESC"
    return f"""WITH g AS (SELECT anomaly_score + 0.0 AS s, sum(CASE WHEN anomaly_label = 1 THEN 1 ELSE 0 END) AS pos,
     sum(CASE WHEN anomaly_label = 1 THEN 0 ELSE 1 END) AS neg FROM ({E_RAW}) e GROUP BY anomaly_score + 0.0),
c AS (SELECT s, CAST(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
      CAST(sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp,
      CAST(sum(pos) OVER () AS BIGINT) AS P FROM g),
d AS (SELECT s AS threshold, tp, fp, P - tp AS fn FROM c),
v AS (SELECT *, {val} AS value FROM d)
SELECT {o.r6('threshold', 'threshold')}, {o.r6('value', 'value')}, tp, fp, fn FROM v ORDER BY {order} LIMIT 1"""


SQL["threshold_max_f1"] = best_sql("f1")
SQL["threshold_min_cost"] = best_sql("cost")


def grouped_pred_sql(src_ctes: str, src: str, key: str) -> str:
    return f"""{src_ctes}, th AS (SELECT {key}, quantile_cont(anomaly_score, 0.99) AS threshold FROM {src}
  WHERE split = 'train' GROUP BY {key})
SELECT x.event_id, x.{key}, {o.r6('th.threshold', 'threshold')},
  coalesce(CAST(x.anomaly_score >= th.threshold AS INTEGER), 0) AS pred_group
FROM {src} x LEFT JOIN th USING ({key})"""


SQL["threshold_per_asset"] = grouped_pred_sql(f"WITH e AS ({E_RAW})", "e", "asset_id")
SQL["threshold_per_regime"] = grouped_pred_sql(f"WITH e AS ({E_RAW})", "e", "regime")
SQL["threshold_per_cluster"] = grouped_pred_sql(_SC.rstrip(), "scored", "cluster")

# --- clustering on F3 ------------------------------------------------------------------
VDIMS = 64  # width of the embeddings table
VCOLS = [f"x{i}" for i in range(VDIMS)]


def vec_ctes(k: int = 4, steps: int = 4) -> tuple[list[str], str]:
    ctes = [f"v AS ({o.f3_sql(VDIMS)})",
            f"pts AS (SELECT vec_id AS _rid, {', '.join(VCOLS)} FROM v)",
            "centres0 AS (SELECT CAST(row_number() OVER (ORDER BY _rid) - 1 AS INTEGER) AS cid, "
            + ", ".join(f"{c} AS c_{c}" for c in VCOLS) + f" FROM (SELECT * FROM pts ORDER BY _rid LIMIT {k}) z)"]
    lloyd, final = o.lloyd_sql("pts", "centres0", VCOLS, k, steps)
    ctes += lloyd
    ctes.append(f"near AS ({o.nearest_sql('pts', final, VCOLS)})")
    return ctes, final


_VC, _VFINAL = vec_ctes()
_VW = "WITH " + ",\n".join(_VC) + "\n"
SQL["kmeans_fixed_init"] = _VW + f"SELECT cid, {', '.join(o.r6('c_' + c, c) for c in VCOLS)} FROM {_VFINAL}"
SQL["assign_cluster"] = _VW + "SELECT _rid AS vec_id, cid AS cluster FROM near"
SQL["nearest_centroid_score"] = _VW + f"SELECT _rid AS vec_id, {o.r6('sqrt(d2)', 'anomaly_score')} FROM near"
SQL["inertia"] = _VW + f"SELECT {o.r6('sum(d2)', 'inertia')} FROM near"


def gmm_em_sql(k: int = 3, steps: int = 4, ridge: float = 1e-6) -> str:
    """EM on (x0, x1) from the k lowest-id rows, equal weights and unit covariances."""
    ctes = ["p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)",
            f"m0 AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cid, 1.0 / {k} AS w, x AS mx, y AS my, "
            f"CAST(1.0 AS DOUBLE) AS cxx, CAST(0.0 AS DOUBLE) AS cxy, CAST(1.0 AS DOUBLE) AS cyy "
            f"FROM (SELECT * FROM p ORDER BY vec_id LIMIT {k}) z)"]
    for t in range(steps):
        ctes += [
            f"f{t} AS (SELECT *, cxx + {ridge} AS a, cyy + {ridge} AS c, (cxx + {ridge}) * (cyy + {ridge}) - cxy * cxy AS det FROM m{t})",
            f"l{t} AS (SELECT vec_id, x, y, cid, ln(w) - ln(2 * pi()) - 0.5 * ln(det) - 0.5 * (c * (x - mx) * (x - mx) "
            f"- 2 * cxy * (x - mx) * (y - my) + a * (y - my) * (y - my)) / det AS l FROM p, f{t})",
            f"t{t} AS (SELECT vec_id, top + ln(sum(exp(l - top))) AS total FROM (SELECT vec_id, l, max(l) OVER (PARTITION BY vec_id) AS top "
            f"FROM l{t}) q GROUP BY vec_id, top)",
            f"r{t} AS (SELECT l.*, exp(l.l - t.total) AS r FROM l{t} l JOIN t{t} t USING (vec_id))",
            f"n{t} AS (SELECT cid, sum(r) AS n, sum(r * x) / sum(r) AS mx, sum(r * y) / sum(r) AS my FROM r{t} GROUP BY cid)",
            f"m{t + 1} AS (SELECT n.cid, any_value(n.n) / (SELECT sum(n) FROM n{t}) AS w, any_value(n.mx) AS mx, any_value(n.my) AS my, "
            f"sum(r * (x - n.mx) * (x - n.mx)) / sum(r) AS cxx, sum(r * (x - n.mx) * (y - n.my)) / sum(r) AS cxy, "
            f"sum(r * (y - n.my) * (y - n.my)) / sum(r) AS cyy FROM r{t} r JOIN n{t} n USING (cid) GROUP BY n.cid)"]
    pairs = (("w", "weight"), ("mx", "mean0"), ("my", "mean1"), ("cxx", "cov00"), ("cxy", "cov01"), ("cyy", "cov11"))
    return ("WITH " + ",\n".join(ctes) + f"\nSELECT cid, {', '.join(o.r6(a, b) for a, b in pairs)}, "
            f"round((SELECT sum(total) FROM t{steps - 1}), 6) + 0.0 AS log_likelihood FROM m{steps}")


SQL["gmm_fixed_init"] = gmm_em_sql()


def pca_sql(d: int = 4, steps: int = 6) -> str:
    """Two rows of subspace iteration on the covariance of x0 .. x(d-1), from the first two axes."""
    xs = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(d))
    c = lambda i, j: f"c{min(i, j)}{max(i, j)}"
    cov = ", ".join(f"covar_pop(x{i}, x{j}) AS {c(i, j)}" for i in range(d) for j in range(i, d))
    q = "SELECT *, " + ", ".join(f"CAST({float(i == j)} AS DOUBLE) AS {n}{i}" for n, j in (("a", 0), ("b", 1)) for i in range(d)) + " FROM cov"
    keep = ", ".join(c(i, j) for i in range(d) for j in range(i, d))
    dot = lambda u, v: " + ".join(f"{u}{i} * {v}{i}" for i in range(d))
    for _ in range(steps):
        y = ", ".join("(" + " + ".join(f"{n}{j} * {c(i, j)}" for j in range(d)) + f") AS y{n}{i}" for n in "ab" for i in range(d))
        q = f"SELECT {keep}, {y} FROM ({q}) s"
        q = f"SELECT *, {', '.join(f'ya{i} / sqrt({dot('ya', 'ya')}) AS a{i}' for i in range(d))} FROM ({q}) s"
        q = f"SELECT *, {', '.join(f'yb{i} - ({dot('a', 'yb')}) * a{i} AS z{i}' for i in range(d))} FROM ({q}) s"
        q = f"SELECT {keep}, {', '.join(f'a{i}' for i in range(d))}, {', '.join(f'z{i} / sqrt({dot('z', 'z')}) AS b{i}' for i in range(d))} FROM ({q}) s"
    trace = " + ".join(c(i, i) for i in range(d))
    form = lambda n: " + ".join(f"{n}{i} * {n}{j} * {c(i, j)}" for i in range(d) for j in range(d))
    row = lambda k, n: (f"SELECT CAST({k} AS INTEGER) AS component, {', '.join(o.r6(f'{n}{i}', f'x{i}') for i in range(d))}, "  # noqa: E731
                        f"{o.r6(f'({form(n)}) / ({trace})', 'explained')} FROM fin")
    return f"WITH v AS (SELECT {xs} FROM embeddings), cov AS (SELECT {cov} FROM v), fin AS ({q})\n{row(0, 'a')} UNION ALL {row(1, 'b')}"


SQL["pca_fixed_steps"] = pca_sql()


def silhouette_sql(label_cte: str, label_col: str) -> str:
    dist = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in VCOLS)
    return f"""{label_cte},
d AS (SELECT a.vec_id AS i, a.{label_col} AS li, b.{label_col} AS lj, sqrt({dist}) AS dist
      FROM lv a JOIN lv b ON a.vec_id <> b.vec_id),
m AS (SELECT i, li, lj, avg(dist) AS m FROM d GROUP BY i, li, lj),
ab AS (SELECT i, max(CASE WHEN li = lj THEN m END) AS a, min(CASE WHEN li <> lj THEN m END) AS b FROM m GROUP BY i)
SELECT {o.r6('sum(CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END) / (SELECT count(*) FROM lv)', 'silhouette')}
FROM ab"""


SQL["silhouette_sample"] = silhouette_sql(f"WITH lv AS ({o.f3_sql(VDIMS)})", "label")
SQL["silhouette_kmeans"] = silhouette_sql(
    _VW.rstrip() + ", lv AS (SELECT v.*, near.cid AS cluster FROM v JOIN near ON v.vec_id = near._rid)", "cluster")
SQL["davies_bouldin"] = _VW + f""", s AS (SELECT cid, avg(sqrt(d2)) AS s FROM near GROUP BY cid),
cc AS (SELECT f.*, s.s FROM {_VFINAL} f JOIN s USING (cid)),
r AS (SELECT a.cid, max((a.s + b.s) / sqrt({' + '.join(f'(a.c_{c} - b.c_{c}) * (a.c_{c} - b.c_{c})' for c in VCOLS)})) AS r
      FROM cc a JOIN cc b ON a.cid <> b.cid GROUP BY a.cid)
SELECT {o.r6('avg(r)', 'davies_bouldin')} FROM r"""


def gmm_label_sql() -> str:
    params = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) + 1e-6 AS v_{c}" for c in VCOLS)
    lp = (" - 0.5 * (" + " + ".join(f"ln(p.v_{c})" for c in VCOLS) + f" + {len(VCOLS)} * ln(2 * pi()))"
          + " - 0.5 * (" + " + ".join(f"(v.{c} - p.m_{c}) * (v.{c} - p.m_{c}) / p.v_{c}" for c in VCOLS) + ")")
    return f"""WITH v AS ({o.f3_sql(VDIMS)}),
p AS (SELECT label, count(*) * 1.0 / (SELECT count(*) FROM v) AS w, {params} FROM v GROUP BY label),
lp AS (SELECT v.vec_id, ln(p.w){lp} AS lp FROM v, p),
mx AS (SELECT vec_id, max(lp) AS m FROM lp GROUP BY vec_id)
SELECT lp.vec_id, {o.r6('-(mx.m + ln(sum(exp(lp.lp - mx.m))))', 'anomaly_score')}
FROM lp JOIN mx USING (vec_id) GROUP BY lp.vec_id, mx.m"""


SQL["gmm_score"] = gmm_label_sql()
SQL["gmm_score_batches"] = gmm_label_sql()

# --- documented extensions -----------------------------------------------------------
_FILLED_SPLIT = o.filled_sql(F1S, EV)


def _long_sql() -> str:
    parts = [f"SELECT split, '{c}' AS sensor, CAST({c} AS DOUBLE) AS value FROM w" for c in EV.fill_columns]
    return f"w AS ({_FILLED_SPLIT}), long AS (SELECT * FROM ({' UNION ALL '.join(parts)}) u WHERE value IS NOT NULL)"


SQL["drift_ks"] = f"""WITH {_long_sql()},
g AS (SELECT sensor, value + 0.0 AS value, sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS a,
      sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS b FROM long GROUP BY sensor, value + 0.0),
c AS (SELECT sensor, sum(a) OVER (PARTITION BY sensor ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ca,
      sum(b) OVER (PARTITION BY sensor ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cb,
      sum(a) OVER (PARTITION BY sensor) AS A, sum(b) OVER (PARTITION BY sensor) AS B FROM g)
SELECT sensor, {o.r6('max(abs(ca / A - cb / B))', 'ks_stat')}, CAST(max(A) AS BIGINT) AS n_ref, CAST(max(B) AS BIGINT) AS n_cur
FROM c GROUP BY sensor"""
_QS = ", ".join(str(round(i / 10, 12)) for i in range(1, 10))
SQL["drift_psi"] = f"""WITH {_long_sql()},
e AS (SELECT sensor, quantile_cont(value, [{_QS}]) AS q FROM long WHERE split = 'train' GROUP BY sensor),
bk AS (SELECT l.sensor, l.split, ({' + '.join(f'CAST(l.value > e.q[{i}] AS INTEGER)' for i in range(1, 10))}) AS bucket
       FROM long l JOIN e USING (sensor) WHERE l.split IN ('train', 'test')),
cnt AS (SELECT sensor, bucket, sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS a,
        sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS b FROM bk GROUP BY sensor, bucket),
tot AS (SELECT sensor, sum(a) AS A, sum(b) AS B FROM cnt GROUP BY sensor),
grid AS (SELECT tot.*, CAST(r.range AS INTEGER) AS bucket FROM tot, range(10) r),
j AS (SELECT grid.sensor, greatest(coalesce(cnt.a, 0) / grid.A, 1e-6) AS p, greatest(coalesce(cnt.b, 0) / grid.B, 1e-6) AS q
      FROM grid LEFT JOIN cnt USING (sensor, bucket))
SELECT sensor, {o.r6('sum((q - p) * ln(q / p))', 'psi')} FROM j GROUP BY sensor"""
SQL["drift_anomaly_rate"] = (f"SELECT date_trunc('day', timestamp) AS period, asset_id, count(*) AS n_rows, "
                             f"{o.r6('avg(CAST(anomaly_pred AS DOUBLE))', 'rate')}, {o.r6('CAST(0.01 AS DOUBLE)', 'expected_rate')}, "
                             f"{o.r6('avg(CAST(anomaly_pred AS DOUBLE)) - 0.010000000000000009', 'excess')} "
                             f"FROM ({E_R}) e GROUP BY date_trunc('day', timestamp), asset_id")
SQL["training_sanity"] = (f"SELECT count(*) AS n_train, {o.r6('avg(CASE WHEN fault_code_true <> 0 THEN 1.0 ELSE 0.0 END)', 'fault_share')}, "
                          f"avg(CASE WHEN fault_code_true <> 0 THEN 1.0 ELSE 0.0 END) > 0.05 AS alert "
                          f"FROM ({E_R}) e WHERE split = 'train'")
SQL["temporal_cv"] = f"""WITH f AS ({o.F1_SQL}), m AS (SELECT min(timestamp) AS m FROM f),
d AS (SELECT f.*, CAST(floor(((epoch_us(f.timestamp) / 1e6 - epoch_us(m.m) / 1e6) / 86400.0 - 14) / 4) AS INTEGER) AS v FROM f, m),
x AS (SELECT d.*, CAST(r.range AS INTEGER) AS fold FROM d, range(3) r WHERE r.range >= d.v)
SELECT fold, CASE WHEN fold = v THEN 'validate' ELSE 'train' END AS role, count(*) AS n_rows,
       min(timestamp) AS ts_min, max(timestamp) AS ts_max FROM x GROUP BY ALL"""


def cv_metrics_sql(first: int = 14, step: int = 4, folds: int = 3, p: float = 0.99) -> str:
    feats = o.feature_list(EV)
    ctes = [f"feats AS ({o.events_features_sql()})",
            "blocks AS (SELECT f.*, greatest(CAST(floor(((epoch_us(f.timestamp) / 1e6 - (SELECT epoch_us(min(timestamp)) / 1e6 FROM feats)) / 86400.0 "
            f"- {first}) / {step}) AS INTEGER), -1) AS v FROM feats f)"]
    for f in range(folds):
        src = f"SELECT *, CASE WHEN v < {f} THEN 'train' ELSE 'validate' END AS split FROM blocks WHERE v <= {f}"
        ctes += [f"scaled{f} AS ({o.scaled_sql(src, feats)})",
                 f"dist{f} AS (SELECT split, anomaly_label, fault_code_true, sqrt({' + '.join(f'{c} * {c}' for c in feats)}) AS anomaly_score FROM scaled{f})",
                 f"held{f} AS (SELECT {f} AS fold, t AS threshold, d.*, CAST(anomaly_score >= t AS INT) AS anomaly_pred FROM dist{f} d, "
                 f"(SELECT quantile_cont(anomaly_score, {p}) AS t FROM dist{f} WHERE split = 'train') q WHERE split = 'validate')"]
    union = " UNION ALL ".join(f"SELECT * FROM held{f}" for f in range(folds))
    q = evaluate_sql(f"SELECT * FROM ({union}) u", ["fold", "threshold"])
    return "WITH " + ",\n".join(ctes) + f"\nSELECT * REPLACE (round(threshold, 6) + 0.0 AS threshold) FROM ({q}) e"


SQL["temporal_cv_metrics"] = cv_metrics_sql()
SQL["telemetry_rejects"] = """SELECT event_id, CASE WHEN event_id % 97 = 0 AND event_id % 101 = 0 THEN 's1,timestamp' WHEN event_id % 97 = 0 THEN 's1'
       WHEN event_id % 101 = 0 THEN 'timestamp' ELSE '' END AS columns FROM events"""
_W15 = o.win(EV, "14 PRECEDING AND CURRENT ROW")
SQL["smoothed_diff"] = out(
    "SELECT *, " + ", ".join(f"avg(_d_{s}) OVER {_W15} AS {s}_diff_smooth" for s in EV.sensors)
    + " FROM (SELECT *, " + ", ".join(f"coalesce({s} - lag({s}) OVER {o.win(EV)}, 0.0) AS _d_{s}" for s in EV.sensors)
    + f" FROM ({_filled_ev}) f) g", F1_OTHERS + flags(EV), F1_DOUBLES + [f"{s}_diff_smooth" for s in EV.sensors])
SQL["lag_features"] = out(
    "SELECT *, " + ", ".join(f"lag({s}, {k}) OVER {o.win(EV)} AS {s}_lag{k}" for s in EV.sensors for k in (1, 5, 15))
    + f" FROM ({_filled_ev}) f", F1_OTHERS + flags(EV), F1_DOUBLES + [f"{s}_lag{k}" for s in EV.sensors for k in (1, 5, 15)])
SQL["rolling_cross_corr"] = out(
    "SELECT *, " + ", ".join(
        f"CASE WHEN NOT (max({a}) OVER {_W15} = min({a}) OVER {_W15} OR max({b}) OVER {_W15} = min({b}) OVER {_W15}) "
        f"THEN corr({a}, {b}) OVER {_W15} END AS corr_{a}_{b}" for a, b in (("s1", "s2"), ("s1", "s3"), ("s2", "s3")))
    + f" FROM ({_filled_ev}) f", F1_OTHERS + flags(EV),
    F1_DOUBLES + [f"corr_{a}_{b}" for a, b in (("s1", "s2"), ("s1", "s3"), ("s2", "s3"))])
SQL["asset_median_impute"] = out(
    f"SELECT f.* EXCLUDE (s1, s2), coalesce(f.s1, m.m1) AS s1, coalesce(f.s2, m.m2) AS s2 FROM ({o.F1_SQL}) f "
    f"LEFT JOIN (SELECT asset_id, quantile_cont(s1, 0.5) AS m1, quantile_cont(s2, 0.5) AS m2 FROM ({o.F1_SQL}) g "
    f"GROUP BY asset_id) m USING (asset_id)", F1_OTHERS, F1_DOUBLES)

# --- jobs, sources, sinks --------------------------------------------------------------
SQL["detect_anomalies_job"] = _flagship()
SQL["detect_anomalies_incremental"] = _flagship()
SQL["scored_tables_incremental"] = _flagship()
SQL["threshold_sketch"] = """
WITH e AS (SELECT user_id AS asset_id, CAST(ts AS DATE) AS d FROM events)
SELECT 'all' AS scope, CAST(1 AS BIGINT) AS n_groups, count(*) AS n_rows, true AS within_bound FROM e
UNION ALL SELECT 'last_ten_days', CAST(1 AS BIGINT), count(*), true FROM e WHERE d > (SELECT max(d) FROM e) - INTERVAL 10 DAY
UNION ALL SELECT 'by_asset', count(DISTINCT asset_id), count(*), true FROM e"""


def stream_kmeans_sql(k: int = 4, batches: int = 3) -> str:
    ctes = [f"v AS ({o.f3_sql(VDIMS)})", f"pts AS (SELECT vec_id AS _rid, {', '.join(VCOLS)} FROM v)",
            "c0 AS (SELECT CAST(row_number() OVER (ORDER BY _rid) - 1 AS INTEGER) AS cid, CAST(0 AS BIGINT) AS n, "
            + ", ".join(f"{c} AS c_{c}" for c in VCOLS) + f" FROM (SELECT * FROM pts ORDER BY _rid LIMIT {k}) z)"]
    for t in range(batches):
        ctes += [f"b{t} AS (SELECT * FROM pts WHERE _rid % {batches} = {t})", f"near{t} AS ({o.nearest_sql(f'b{t}', f'c{t}', VCOLS)})",
                 f"s{t} AS (SELECT cid, count(*) AS m, {', '.join(f'sum({c}) AS s_{c}' for c in VCOLS)} FROM near{t} JOIN b{t} USING (_rid) GROUP BY cid)",
                 f"c{t + 1} AS (SELECT c.cid, c.n + coalesce(s.m, 0) AS n, "
                 + ", ".join(f"CASE WHEN s.m IS NULL THEN c.c_{c} ELSE (c.n * c.c_{c} + s.s_{c}) / (c.n + s.m) END AS c_{c}" for c in VCOLS)
                 + f" FROM c{t} c LEFT JOIN s{t} s USING (cid))"]
    return "WITH " + ",\n".join(ctes) + f"\nSELECT cid, n, {', '.join(o.r6('c_' + c, c) for c in VCOLS)} FROM c{batches}"


SQL["stream_kmeans"] = stream_kmeans_sql()
SQL["only_anomalies_job"] = ("WITH " + ",\n".join(scored_ctes()) + "\nSELECT event_id, asset_id, timestamp, "
                             "round(anomaly_score, 6) + 0.0 AS anomaly_score, anomaly_pred FROM scored WHERE anomaly_pred = 1")
SQL["scored_tables"] = _flagship()
SQL["telemetry_csv"] = out(o.F1_SQL, F1_OTHERS, F1_DOUBLES)

# --- streaming -------------------------------------------------------------------------
SQL["stream_score"] = _flagship(causal=True)
SQL["stream_score_stateful"] = _flagship(causal=True)
SQL["stream_anomaly_rate"] = (f"SELECT date_trunc('hour', timestamp) AS window_start, "
                              f"date_trunc('hour', timestamp) + INTERVAL 1 HOUR AS window_end, asset_id, count(*) AS n_rows, "
                              f"{o.r6('avg(CAST(anomaly_pred AS DOUBLE))', 'rate')}, "
                              f"{o.r6('avg(CAST(anomaly_pred AS DOUBLE)) - 0.010000000000000009', 'excess')} "
                              f"FROM ({E_R}) e GROUP BY ALL")

# --- single-operator forms ------------------------------------------------------------
SQL["local_zscore"] = out(o.events_features_sql(), ["event_id"], [f"{s}_zscore" for s in EV.sensors])
SQL["lookahead_check"] = (f"SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differ FROM ({o.F1_SQL}) f "
                          f"WHERE epoch_us(timestamp) <= (SELECT quantile_cont(epoch_us(timestamp), 0.6) FROM ({o.F1_SQL}) g)")
_FEATS = o.feature_list(EV)
SQL["standardize"] = out(o.scaled_sql(o.split_sql(o.events_features_sql(), EV, 21), _FEATS), ["event_id", "split"], _FEATS)
SQL["fit_threshold"] = (_SC + "SELECT split, CAST(sum(anomaly_pred) AS BIGINT) AS n_pred, count(*) AS n_rows, "
                        f"{o.r6('max(t)', 'threshold')} FROM scored, thr GROUP BY split")
SQL["model_source"] = _flagship()
SQL["metrics_sink"] = _SC + f"""SELECT m.*, CAST(3 AS BIGINT) AS best_k, {o.r6('(SELECT max(t) FROM thr)', 'threshold')},
  CAST(99.0 AS DOUBLE) AS threshold_percentile, {o.r6("(SELECT sum(anomaly_score * anomaly_score) FROM scored WHERE split = 'train')", 'inertia')},
  (SELECT CAST(min(timestamp) AS TIMESTAMP) + INTERVAL 21 DAY FROM scored) AS cutoff, c.n_rows, c.n_flagged, true AS silhouette_in_range
FROM ({evaluate_sql('SELECT * FROM scored', ['split'])}) m
JOIN (SELECT split, count(*) AS n_rows, CAST(sum(anomaly_pred) AS BIGINT) AS n_flagged FROM scored GROUP BY split) c USING (split)"""


def vote_sql() -> str:
    cols = o.feature_list(EV)
    params = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) + 1e-6 AS v_{c}" for c in cols)
    lp = (" - 0.5 * (" + " + ".join(f"ln(p.v_{c})" for c in cols) + f" + {len(cols)} * ln(2 * pi()))"
          + " - 0.5 * (" + " + ".join(f"(a.{c} - p.m_{c}) * (a.{c} - p.m_{c}) / p.v_{c}" for c in cols) + ")")
    return _SC.rstrip() + f""", mp AS (SELECT regime AS g, count(*) * 1.0 / (SELECT count(*) FROM allpts WHERE split = 'train') AS w, {params}
  FROM allpts WHERE split = 'train' GROUP BY regime),
lp AS (SELECT a.event_id, a.split, ln(p.w){lp} AS lp FROM allpts a, mp p),
mx AS (SELECT event_id, split, max(lp) AS m FROM lp GROUP BY event_id, split),
ms AS (SELECT lp.event_id, lp.split, -(mx.m + ln(sum(exp(lp.lp - mx.m)))) AS s FROM lp JOIN mx USING (event_id) GROUP BY lp.event_id, lp.split, mx.m),
mt AS (SELECT quantile_cont(s, 0.99) AS t FROM ms WHERE split = 'train')
SELECT sc.event_id, sc.anomaly_pred, {o.r6('ms.s', 'mixture_score')}, CAST(ms.s >= mt.t AS INTEGER) AS pred_mixture,
       CAST(sc.anomaly_pred = 1 OR ms.s >= mt.t AS INTEGER) AS pred_vote
FROM scored sc JOIN ms USING (event_id), mt"""


SQL["ensemble_vote"] = vote_sql()
SQL["model_sink"] = (_SC + " UNION ALL ".join(
    f"SELECT cid, CAST({i} AS INTEGER) AS idx, {o.r6('c_' + c, 'value')} FROM centres5"
    for i, c in enumerate(o.feature_list(EV))))
