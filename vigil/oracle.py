"""DuckDB twins of the registered queries (verification only).

Each function returns ANSI SQL over the pre-registered views (events, lineitem,
embeddings, ...). The fixture definitions are the SQL texts of FIXTURES.md; operators are
written independently of the Spark code, as plain window / aggregate SQL.
Conventions shared with the Spark side: doubles rounded to 6 places, counts BIGINT, flags
INT, no -0.0 (``+ 0.0``), total order in every window.
"""

from __future__ import annotations

from typing import Sequence

from vigil.config import EVENTS_SPEC, TelemetrySpec

F1_SQL = """
SELECT event_id, asset_id, timestamp, regime, load_pct,
  CASE WHEN event_id % 26 = 0
         OR (blk % 3 = 1 AND (rn - 1) % 16 < (blk + asset_id) % 14)
         OR (asset_id % 10 = 0 AND rn <= 7)
         OR (asset_id % 10 = 1 AND rn_desc <= 7) THEN NULL ELSE value END AS s1,
  CASE WHEN event_id % 31 = 5 THEN NULL ELSE k END AS s2,
  CASE WHEN asset_id % 25 = 7 THEN CAST(5.0 AS DOUBLE) ELSE value * 0.5 + k END AS s3,
  CASE WHEN value >= 200 THEN 2 WHEN event_type = 'error' AND value >= 100 THEN 1 ELSE 0 END AS fault_code_true,
  CASE WHEN value >= 150 AND event_id % 3 <> 0 THEN 1 ELSE 0 END AS anomaly_label
FROM (
  SELECT event_id, user_id AS asset_id, ts AS timestamp, value, event_type,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k,
    CASE WHEN event_type IN ('view','click') THEN 0 WHEN event_type = 'signup' THEN 1 ELSE 2 END AS regime,
    CAST(hour(ts) AS DOUBLE) * 4 AS load_pct,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn_desc,
    CAST(floor((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) / 16) AS BIGINT) AS blk
  FROM events) t
"""

F2_SQL = """
SELECT l_suppkey AS asset_id, l_shipdate AS timestamp, CAST(rn AS BIGINT) AS rn,
  CASE WHEN rn % 27 = 0 THEN NULL ELSE l_quantity END AS s1,
  CASE WHEN rn % 100 BETWEEN 40 AND 52 THEN NULL ELSE l_extendedprice END AS s2,
  l_discount + 0.0 AS s3, l_tax + 0.0 AS s4,
  CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS regime
FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber,
      l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
      FROM lineitem) t
"""


def f3_sql(dims: int = 8) -> str:
    xs = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(dims))
    return f"SELECT vec_id, {xs}, label FROM embeddings"


def f4_sql(rounded: bool = True) -> str:
    score = "round(coalesce(s1, 0.0), 0)" if rounded else "coalesce(s1, 0.0)"
    return f"""SELECT event_id, asset_id, timestamp, {score} AS anomaly_score, anomaly_label, fault_code_true,
       CASE WHEN coalesce(s1, 0.0) >= 150 THEN 1 ELSE 0 END AS anomaly_pred
FROM ({F1_SQL}) f"""


def r6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) + 0.0 AS {alias}"


def order_by(spec: TelemetrySpec) -> str:
    return ", ".join(spec.order)


def win(spec: TelemetrySpec, frame: str | None = None) -> str:
    f = f" ROWS BETWEEN {frame}" if frame else ""
    return f"(PARTITION BY {spec.asset} ORDER BY {order_by(spec)}{f})"


def filled_sql(src: str, spec: TelemetrySpec, limit: int = 5, causal: bool = False,
               sentinel: bool = True, flags: bool = True) -> str:
    """Flags + ffill(limit) + bfill(limit) on the ffilled series + 0 sentinel."""
    cols = list(spec.fill_columns)
    others = "*" if not cols else "* EXCLUDE (" + ", ".join(cols) + ")"
    flag_sql = "".join(f", CAST({c} IS NULL AS INT) AS {c}_was_nan" for c in cols) if flags else ""
    ff = ", ".join(f"last_value({c} IGNORE NULLS) OVER {win(spec, f'{limit} PRECEDING AND CURRENT ROW')} AS {c}"
                   for c in cols)
    step1 = f"SELECT {others}{flag_sql}, {ff} FROM ({src}) s0"
    if causal:
        step2 = step1
    else:
        bf = ", ".join(f"first_value({c} IGNORE NULLS) OVER {win(spec, f'CURRENT ROW AND {limit} FOLLOWING')} AS {c}"
                       for c in cols)
        step2 = f"SELECT {others}, {bf} FROM ({step1}) s1"
    if not sentinel:
        return step2
    z = ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in cols)
    return f"SELECT {others}, {z} FROM ({step2}) s2"


def derived_sql(spec: TelemetrySpec, add_diff: bool = True, add_zscore: bool = True) -> list[str]:
    names = [n for s in spec.sensors for n in (f"{s}_roll_mean", f"{s}_roll_std")]
    if add_diff:
        names += [f"{s}_diff" for s in spec.sensors]
    if add_zscore:
        names += [f"{s}_zscore" for s in spec.sensors]
    return names


def features_sql(src: str, spec: TelemetrySpec, window: int = 15, add_diff: bool = True,
                 add_zscore: bool = True) -> str:
    w = win(spec, f"{window - 1} PRECEDING AND CURRENT ROW")
    parts = []
    for s in spec.sensors:
        parts.append(f"avg({s}) OVER {w} AS {s}_roll_mean")
        parts.append(f"coalesce(CASE WHEN max({s}) OVER {w} = min({s}) OVER {w} THEN 0.0 "
                     f"ELSE stddev_pop({s}) OVER {w} END, 0.0) AS {s}_roll_std")
    if add_diff:
        parts += [f"coalesce({s} - lag({s}) OVER {win(spec)}, 0.0) AS {s}_diff" for s in spec.sensors]
    step = f"SELECT *, {', '.join(parts)} FROM ({src}) r0"
    if not add_zscore:
        return step
    z = ", ".join(f"coalesce(CASE WHEN {s}_roll_std <> 0 THEN ({s} - {s}_roll_mean) / {s}_roll_std END, 0.0) "
                  f"AS {s}_zscore" for s in spec.sensors)
    return f"SELECT *, {z} FROM ({step}) r1"


def feature_list(spec: TelemetrySpec, include_context: bool = True) -> list[str]:
    return list(spec.sensors) + derived_sql(spec) + (list(spec.context) if include_context else [])


def events_features_sql(window: int = 15, limit: int = 5, causal: bool = False) -> str:
    return features_sql(filled_sql(F1_SQL, EVENTS_SPEC, limit, causal), EVENTS_SPEC, window)


def split_sql(src: str, spec: TelemetrySpec, train_days: int) -> str:
    return (f"SELECT *, CASE WHEN {spec.ts} < (SELECT min({spec.ts}) FROM ({src}) m) + INTERVAL {train_days} DAY "
            f"THEN 'train' ELSE 'test' END AS split FROM ({src}) x")


def scaled_sql(src: str, feats: Sequence[str]) -> str:
    """``src`` has a split column; scaler fitted on train rows (population std, 0 → 1)."""
    stats = ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1.0) AS s_{c}" for c in feats)
    others = "t.* EXCLUDE (" + ", ".join(feats) + ")"
    sc = ", ".join(f"(t.{c} - st.m_{c}) / st.s_{c} AS {c}" for c in feats)
    return (f"SELECT {others}, {sc} FROM ({src}) t, "
            f"(SELECT {stats} FROM ({src}) q WHERE split = 'train') st")


def sqd(feats: Sequence[str], centre_alias: str) -> str:
    return " + ".join(f"(x.{c} - {centre_alias}.c_{c}) * (x.{c} - {centre_alias}.c_{c})" for c in feats)


def lloyd_sql(points: str, init_centres: str, feats: Sequence[str], k: int, steps: int) -> tuple[list[str], str]:
    """CTEs for ``steps`` Lloyd updates. ``points`` / ``init_centres`` are CTE names; centres
    have columns (cid, c_<f>...). Ties go to the lowest centre id; an empty cluster keeps
    its centre. Returns (cte definitions, name of the final centre CTE)."""
    ctes = []
    prev = init_centres
    for t in range(steps):
        a = f"assign{t}"
        ctes.append(f"""{a} AS ({nearest_sql(points, prev, feats)})""")
        nxt = f"centres{t + 1}"
        avgs = ", ".join(f"coalesce(n.c_{c}, p.c_{c}) AS c_{c}" for c in feats)
        means = ", ".join(f"avg(x.{c}) AS c_{c}" for c in feats)
        ctes.append(f"""{nxt} AS (
  SELECT p.cid, {avgs} FROM {prev} p LEFT JOIN (
    SELECT a.cid, {means} FROM {a} a JOIN {points} x USING (_rid) GROUP BY a.cid) n USING (cid))""")
        prev = nxt
    return ctes, prev


def nearest_sql(points: str, centres: str, feats: Sequence[str]) -> str:
    """(_rid, cid, d2) of the nearest centre per point; ties → lowest centre id."""
    return f"""SELECT _rid, cid, d2 FROM (
    SELECT x._rid, c.cid, {sqd(feats, 'c')} AS d2,
           row_number() OVER (PARTITION BY x._rid ORDER BY {sqd(feats, 'c')}, c.cid) AS _r
    FROM {points} x, {centres} c) dd WHERE _r = 1"""
