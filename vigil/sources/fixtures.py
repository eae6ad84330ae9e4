"""Telemetry fixtures derived from the driver's parquet tables (see FIXTURES.md).

Each fixture is built with the DataFrame API so that it scales with its source table; the
same definition as SQL text (valid in Spark SQL and DuckDB) lives in ``vigil.oracle``.

* F1 ``telemetry_events``   — events → 3 sensors with gaps, regime, load, labels
* F2 ``telemetry_lineitem`` — lineitem → 4 sensors, long series, ties in time
* F3 ``vectors``            — embeddings → x0..x63 doubles (the data's width) + label
* F4 ``scored``             — F1 with a rounded score and a prediction (evaluation input)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.plans.layout import POS, hot_keys, join_small, positional_index


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_row_numbers(df: DataFrame, key: str, order: list, max_series_rows: int | None = 4_000_000,
                     rn: str = "rn", n: str = "_n") -> DataFrame:
    """Add 1-based ``rn`` along ``order`` inside ``key`` and the series length ``n``.

    Keys up to ``max_series_rows`` rows use one per-key window; longer (hot) keys use the
    range-partitioned positional index, so a hot key is spread over many tasks.
    """
    def plain(d):
        w = Window.partitionBy(key).orderBy(*order)
        return (d.withColumn(rn, F.row_number().over(w).cast("bigint"))
                .withColumn(n, F.count(F.lit(1)).over(Window.partitionBy(key))))

    if max_series_rows is None:
        return plain(df)
    hot, n_hot = hot_keys(df, key, max_series_rows)
    if n_hot == 0:
        return plain(df)
    cold = plain(join_small(df, hot, key, n_hot, "left_anti"))
    hot_rows = join_small(df, hot, key, n_hot, "left_semi")
    counts = hot_rows.groupBy(key).agg(F.count(F.lit(1)).alias(n))
    idx = positional_index(hot_rows, [key], order, n_keys=n_hot)
    hot_out = join_small(idx.withColumn(rn, F.col(POS) + 1).drop(POS), counts, key, n_hot)
    return cold.unionByName(hot_out.select(*cold.columns))


def telemetry_events(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """one row per event, assets = users, total order (asset_id, timestamp, event_id)."""
    ev = table(spark, sf_dir, "events")
    base = ev.select(
        "event_id",
        F.col("user_id").alias("asset_id"),
        F.col("ts").alias("timestamp"),
        "value", "event_type",
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("k"),
        F.when(F.col("event_type").isin("view", "click"), 0)
         .when(F.col("event_type") == "signup", 1).otherwise(2).alias("regime"),
        (F.hour("ts").cast("double") * 4).alias("load_pct"),
    )
    t = with_row_numbers(base, "asset_id", ["timestamp", "event_id"], **kw)
    rn, asset, eid = F.col("rn"), F.col("asset_id"), F.col("event_id")
    rn_desc = F.col("_n") - rn + 1
    blk = F.floor((rn - 1) / 16)
    s1_missing = ((eid % 26 == 0)
                  | ((blk % 3 == 1) & ((rn - 1) % 16 < (blk + asset) % 14))
                  | ((asset % 10 == 0) & (rn <= 7))
                  | ((asset % 10 == 1) & (rn_desc <= 7)))
    value, k = F.col("value"), F.col("k")
    return t.select(
        "event_id", "asset_id", "timestamp", "regime", "load_pct",
        F.when(s1_missing, F.lit(None)).otherwise(value).alias("s1"),
        F.when(eid % 31 == 5, F.lit(None)).otherwise(k).alias("s2"),
        F.when(asset % 25 == 7, F.lit(5.0)).otherwise(value * 0.5 + k).alias("s3"),
        F.when(value >= 200, 2).when((F.col("event_type") == "error") & (value >= 100), 1)
         .otherwise(0).alias("fault_code_true"),
        F.when((value >= 150) & (eid % 3 != 0), 1).otherwise(0).alias("anomaly_label"),
    )


def telemetry_lineitem(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """suppliers as assets, ship dates as time; ``rn`` breaks the ties in time."""
    li = table(spark, sf_dir, "lineitem")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    t = with_row_numbers(li, "l_suppkey", order, **kw)
    rn = F.col("rn")
    return t.select(
        F.col("l_suppkey").alias("asset_id"), F.col("l_shipdate").alias("timestamp"), "rn",
        F.when(rn % 27 == 0, F.lit(None)).otherwise(F.col("l_quantity")).alias("s1"),
        F.when((rn % 100 >= 40) & (rn % 100 <= 52), F.lit(None))
         .otherwise(F.col("l_extendedprice")).alias("s2"),
        (F.col("l_discount") + 0.0).alias("s3"), (F.col("l_tax") + 0.0).alias("s4"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1)
         .otherwise(2).alias("regime"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """all embedding components as double columns x0, x1, …; the width is the data's."""
    emb = table(spark, sf_dir, "embeddings")
    dims = emb.agg(F.max(F.size("embedding"))).first()[0] or 0
    return emb.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"x{i}")
                                  for i in range(dims)], "label")


def vector_columns(v: DataFrame) -> list[str]:
    """The component columns of a vectors table."""
    return [c for c in v.columns if c[0] == "x" and c[1:].isdigit()]


def telemetry_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the reference's 19-column layout derived from ``events`` by fixed rules —
    16 assets (event_id mod 16), 8 sensors and 3 numeric context columns built from the
    event value, its ``k`` property, the hour and the id; ~4 % missing per sensor."""
    ev = table(spark, sf_dir, "events")
    v, eid = F.col("value"), F.col("event_id")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("double")
    hour = F.hour("ts").cast("double")

    def gappy(expr, i):
        return F.when((eid + 7 * i) % 25 == 0, F.lit(None).cast("double")).otherwise(expr.cast("double"))

    sensors = [
        ("rpm", 1500 + v * 3 + k), ("current_a", 10 + v / 20 + k / 50), ("pressure_bar", 5 + k / 20),
        ("flow_lpm", 100 + v / 2 - k / 10), ("temp_c", 40 + v / 10 + hour / 2),
        ("vib_rms", 1 + (eid % 17) / 10 + v / 100), ("vib_crest", 3 + (eid % 7) / 5),
        ("vib_kurtosis", 3 + (k % 13) / 4),
        ("ambient_temp_c", 15 + hour / 2), ("humidity_pct", 40 + (eid % 30).cast("double")),
        ("load_pct", hour * 4),
    ]
    fault = (F.when(v >= 200, 2).when((F.col("event_type") == "error") & (v >= 100), 1).otherwise(0))
    return ev.select(
        F.col("ts").alias("timestamp"),
        (eid % 16).cast("int").alias("asset_id"),
        F.concat(F.lit("S"), (F.col("user_id") % 4).cast("string")).alias("site_id"),
        F.concat(F.lit("L"), (F.col("user_id") % 8).cast("string")).alias("line_id"),
        *[gappy(e, i).alias(name) for i, (name, e) in enumerate(sensors)],
        F.when(F.col("event_type").isin("view", "click"), 0)
         .when(F.col("event_type") == "signup", 1).otherwise(2).alias("regime"),
        fault.alias("fault_code_true"),
        F.when(fault == 2, "overload").when(fault == 1, "sensor_error").alias("fault_type_true"),
        F.when((v >= 150) & (eid % 3 != 0), 1).otherwise(0).alias("anomaly_label"),
    )
