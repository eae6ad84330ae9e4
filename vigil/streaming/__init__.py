from vigil.streaming.monitor import stream_anomaly_rate
from vigil.streaming.score import stream_score

__all__ = ["stream_anomaly_rate", "stream_score"]


def replay(spark, df, ts: str, n_slices: int, folder: str, consume) -> None:
    """Feed ``df`` into a file-source stream in event-time order: slice by time, append one
    slice at a time to ``folder`` and let ``consume()`` (e.g. ``processAllAvailable``) drain
    each before the next (test and backfill harness)."""
    import datetime as dt

    from pyspark.sql import functions as F

    from vigil.operators.split import first_time, ts_lit
    lo = first_time(df, ts)
    hi = dt.datetime.strptime(df.agg(F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0],
                              "%Y-%m-%d %H:%M:%S.%f")
    step = (hi - lo) / n_slices
    for i in range(n_slices):
        cond = F.col(ts) >= ts_lit(df, ts, lo + step * i)
        if i < n_slices - 1:
            cond = cond & (F.col(ts) < ts_lit(df, ts, lo + step * (i + 1)))
        df.filter(cond).write.mode("append").parquet(folder)
        consume()
