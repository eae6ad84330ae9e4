"""Streaming monitor: predicted-anomaly rate per asset and tumbling event-time window,
against the expected rate 1 − p/100. Watermarked, so window state is dropped once late
data can no longer arrive (append mode emits each window once, when it closes)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_anomaly_rate(scored: DataFrame, ts: str, asset: str, pred: str = "anomaly_pred",
                        window: str = "1 hour", watermark: str = "1 hour", percentile: float = 99.0) -> DataFrame:
    expected = 1.0 - percentile / 100.0
    agg = (scored.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
           .groupBy(F.window("_ts", window).alias("w"), asset)
           .agg(F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(pred).cast("double")).alias("rate")))
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), asset,
                      "n_rows", "rate", (F.col("rate") - F.lit(expected)).alias("excess"))
