"""Exact order statistics without gathering a group into one task.

Spark's exact ``percentile`` keeps every value of a group in one aggregation buffer; a
global percentile over 100 TB would put all scores in one task. Here equal values are counted
first, so ties become one row, and the distinct values get running counts (``running_totals``,
spread over range partitions). Only the two neighbours of each requested rank are kept, then
interpolated linearly (numpy's default, DuckDB's ``quantile_cont``). ``approx=True`` uses
``percentile_approx`` (one pass, bounded memory).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.plans.layout import running_totals


def grouped_percentiles(df: DataFrame, value: str, ps: Sequence[float], keys: Sequence[str] = (),
                        approx: bool = False, accuracy: int = 100_000) -> DataFrame:
    """One row per (keys, p) with ``percentile`` = the p-quantile (p in [0, 1]) of ``value``.

    Null values are ignored, null keys are a group like any other. Output columns: *keys, p, percentile.
    """
    keys = list(keys)
    # No null filter here: a filter on a derived score is pushed through (and inlines) the
    # whole scoring projection, which makes constraint inference explode on wide models.
    vals = df.select(*keys, (F.col(value) + F.lit(0.0)).alias("_v"))
    ps_col = F.array(*[F.lit(float(p)) for p in ps])
    if approx:
        agg = vals.groupBy(*keys).agg(F.percentile_approx("_v", ps_col, accuracy).alias("_q"))
        return agg.select(*keys, F.posexplode("_q").alias("_i", "percentile")).select(
            *keys, ps_col[F.col("_i")].alias("p"), "percentile")
    counted = vals.groupBy(*keys, "_v").agg(F.count("_v").alias("_n"))      # the row of nulls counts 0
    ranked = running_totals(counted, ["_v"], ["_n"], keys=keys).filter(F.col("_v").isNotNull())
    first, last = F.col("_n_cum") - F.col("_n"), F.col("_n_cum") - 1        # ranks that hold the value

    def holds(rank):
        return (rank >= first) & (rank <= last)

    wanted = F.transform(ps_col, lambda p: F.struct(p.alias("p"), ((F.col("_n_all") - 1) * p).alias("h")))
    near = F.filter(wanted, lambda x: holds(F.floor(x["h"])) | holds(F.floor(x["h"]) + 1))
    picked = ranked.select(*keys, "_v", first.alias("_first"), last.alias("_last"), F.explode(near).alias("_x"))
    low = F.floor("_x.h")
    return picked.groupBy(*keys, F.col("_x.p").alias("p")).agg(             # at most 2 rows per (keys, p)
        F.max("_x.h").alias("_h"),
        F.max(F.when((low >= F.col("_first")) & (low <= F.col("_last")), F.col("_v"))).alias("_vlo"),
        F.max(F.when((low + 1 >= F.col("_first")) & (low + 1 <= F.col("_last")), F.col("_v"))).alias("_vhi"),
    ).select(*keys, "p", F.when(F.col("_vhi").isNull() | (F.col("_vhi") == F.col("_vlo")) | (F.floor("_h") == F.col("_h")), F.col("_vlo"))
             .otherwise((F.floor("_h") + 1 - F.col("_h")) * F.col("_vlo") + (F.col("_h") - F.floor("_h")) * F.col("_vhi"))
             .alias("percentile"))


def percentiles(df: DataFrame, value: str, ps: Sequence[float], approx: bool = False) -> list[float]:
    """Driver-side list of global percentiles (model-sized result)."""
    rows = grouped_percentiles(df, value, ps, approx=approx).collect()
    by_p = {float(r["p"]): float(r["percentile"]) for r in rows}
    return [by_p[float(p)] for p in ps]


def percentile(df: DataFrame, value: str, p: float, approx: bool = False) -> float:
    return percentiles(df, value, [p], approx)[0]
