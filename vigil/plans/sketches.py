"""Thresholds from mergeable quantile sketches: a small table by day instead of the scores themselves.

Each day's scores become one KLL sketch per key, written once. A threshold for any span of days, for
each key or for all, merges sketches and reads no scores. Its rank error is that of one sketch, however many were merged.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.score import SCORE
from vigil.sources.store import replace_partitions

K = 2000  # accuracy of the sketches


def rank_error(k: int = K) -> float:
    """Normalised rank error that a KLL quantile exceeds with a probability of at most about one percent, to either side."""
    return 2.296 / k ** 0.9021


def score_sketches(scored: DataFrame, ts: str, keys: Sequence[str] = (), score_col: str = SCORE, k: int = K) -> DataFrame:
    """(date, *keys, n, sketch) of the scores that are not null."""
    day = F.to_date(F.col(ts).cast("timestamp")).alias("date")
    return (scored.filter(F.col(score_col).isNotNull()).groupBy(day, *keys)
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(score_col).cast("double"), k).alias("sketch")))


def write_sketches(scored: DataFrame, path: str, ts: str, keys: Sequence[str] = (), score_col: str = SCORE, k: int = K) -> None:
    """Add or replace the sketches of the days that ``scored`` has rows for."""
    replace_partitions(score_sketches(scored, ts, keys, score_col, k), path, ["date"])


def sketch_thresholds(spark: SparkSession, path: str, p: float = 99.0, keys: Sequence[str] = (), first_day: str | None = None,
                      last_day: str | None = None) -> DataFrame:
    """(*keys, n, threshold): the p-th percentile over the days from ``first_day`` to ``last_day``; one row without keys.

    Only the sketches of those days are read. A percentile is the smallest score with at least that share of rows at or below it.
    """
    table = spark.read.parquet(path)
    for day, inside in ((first_day, lambda d: F.col("date") >= d), (last_day, lambda d: F.col("date") <= d)):
        if day is not None:
            table = table.filter(inside(F.lit(day).cast("date")))
    merged = table.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return (merged.filter(F.col("n") > 0)
            .select(*keys, "n", F.kll_sketch_get_quantile_double("sketch", F.lit(p / 100.0)).alias("threshold")))
