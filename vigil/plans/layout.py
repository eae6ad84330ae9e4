"""Physical layout of per-asset series and distributed running totals.

Two helpers that Catalyst does not provide:

* **Skew-safe series windows.** ``Window.partitionBy(asset)`` puts a whole series in one
  task; one asset that holds a third of 100 TB would then be one task. Every series
  operator here has a finite reach (a feature at row t reads rows [t-back, t+ahead]), so a
  long series is cut into row chunks of ``chunk_rows`` rows, each chunk carrying a halo of
  ``back`` rows before and ``ahead`` rows after, and the windows run per (asset, chunk).
  Results on home rows are identical to the unchunked windows.

* **Positional index / running totals without a single-partition window.**
  ``repartitionByRange`` samples the sort key, so partitions are balanced even when one key
  dominates; per-partition counts become exact offsets (a table of at most
  keys + partitions rows), and position = offset + rank inside the partition.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.config import CHUNK_ROWS, MAX_SERIES_ROWS
from vigil.session import checkpointed

POS = "_vg_pos"
CHUNK = "_vg_chunk"
HOME = "_vg_home"
_MID = "_vg_mid"
_PID = "_vg_pid"

# Largest helper table (rows) that may be hinted for broadcast; above it AQE decides from
# measured shuffle sizes (spark.sql.adaptive.autoBroadcastJoinThreshold).
BROADCAST_ROWS = 500_000


def _n_parts(df: DataFrame, n: int | None) -> int:
    if n:
        return int(n)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1)


def join_small(big: DataFrame, small: DataFrame, on, rows_bound: int | None, how: str = "inner") -> DataFrame:
    """Join a helper table on equal keys, null keys included; broadcast it only when its row
    count is provably bounded. Columns of ``big`` come first, in their order."""
    on = [on] if isinstance(on, str) else list(on)
    small = small.withColumnsRenamed({c: f"_js_{c}" for c in on})
    if rows_bound is not None and rows_bound <= BROADCAST_ROWS:
        small = F.broadcast(small)
    same = F.col(on[0]).eqNullSafe(F.col(f"_js_{on[0]}"))
    for c in on[1:]:
        same = same & F.col(c).eqNullSafe(F.col(f"_js_{c}"))
    return big.join(small, same, how).drop(*[f"_js_{c}" for c in on])


def positional_index(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                     n_parts: int | None = None, n_keys: int | None = None,
                     pos_col: str = POS) -> DataFrame:
    """Add ``pos_col`` = 0-based position of each row within its key, along ``order``.

    ``order`` must be a total order inside a key. One range shuffle; the offset table
    has at most ``n_keys + n_parts`` rows.
    """
    keys = list(keys)
    n = _n_parts(df, n_parts)
    sort_cols = [*keys, *order]
    ranged = df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
    # Ids follow the sorted order inside each partition: (partition << 33) + rank. The range
    # bounds come from a sample whose order after a shuffle is not deterministic, so the
    # tagged rows are materialised once and both the counts and the rows read that copy.
    tagged = checkpointed(ranged.withColumn(_MID, F.monotonically_increasing_id())).withColumn(
        _PID, F.shiftright(F.col(_MID), 33))
    stats = tagged.groupBy(*keys, _PID).agg(F.count(F.lit(1)).alias("_n"), F.min(_MID).alias("_m0"))
    before = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    delta = stats.select(*keys, _PID, (F.coalesce(F.sum("_n").over(before), F.lit(0))
                                       - F.col("_m0")).alias("_delta"))
    bound = None if (keys and n_keys is None) else (n_keys or 0) + n
    out = join_small(tagged, delta, [*keys, _PID], bound)
    return out.select(*df.columns, (F.col(_MID) + F.col("_delta")).alias(pos_col))


@dataclass(frozen=True)
class SeriesLayout:
    """Where the series windows run: per asset, or per (asset, chunk) with a halo."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    chunked: bool = False

    def window(self) -> Window:
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def rows(self, lo: int, hi: int) -> Window:
        return self.window().rowsBetween(lo, hi)

    def finish(self, df: DataFrame) -> DataFrame:
        """Drop halo copies and helper columns (call after all windows)."""
        if not self.chunked:
            return df
        return df.filter(F.col(HOME)).drop(POS, CHUNK, HOME)


def hot_keys(df: DataFrame, asset: str, max_series_rows: int) -> tuple[DataFrame, int]:
    """Assets with more than ``max_series_rows`` rows, and how many there are. The table has
    at most rows / max_series_rows entries, so it is a bounded broadcast side."""
    hot = (df.groupBy(asset).agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > max_series_rows).select(asset))
    if hot.isEmpty():                        # the usual case: one aggregate, nothing written
        return hot, 0
    hot = checkpointed(hot)
    return hot, hot.count()


def _chunk(df: DataFrame, asset: str, order: Sequence[str], back: int, ahead: int, chunk_rows: int,
           n_keys: int | None = None) -> tuple[DataFrame, SeriesLayout]:
    if chunk_rows < back + ahead + 1:
        raise ValueError("chunk_rows must exceed the halo (back + ahead)")
    idx = positional_index(df, [asset], list(order), n_keys=n_keys)
    c = F.floor(F.col(POS) / F.lit(chunk_rows)).cast("bigint")
    r = F.col(POS) - c * F.lit(chunk_rows)
    empty = F.array().cast("array<bigint>")
    ids = F.concat(F.array(c),
                   F.when(r >= chunk_rows - back, F.array(c + 1)).otherwise(empty),
                   F.when((r < ahead) & (c > 0), F.array(c - 1)).otherwise(empty))
    out = (idx.withColumn("_vg_home_chunk", c)
           .withColumn(CHUNK, F.explode(ids))
           .withColumn(HOME, F.col(CHUNK) == F.col("_vg_home_chunk"))
           .drop("_vg_home_chunk"))
    return out, SeriesLayout((asset, CHUNK), (POS,), True)


def plan_series(df: DataFrame, asset: str, order: Sequence[str], back: int, ahead: int,
                max_series_rows: int | None = MAX_SERIES_ROWS, chunk_rows: int = CHUNK_ROWS,
                force_chunks: bool | None = None) -> list[tuple[DataFrame, SeriesLayout]]:
    """Split ``df`` into parts, each with the layout its series windows run under.

    ``force_chunks=None`` measures series lengths first (one aggregate on the asset column).
    Only assets longer than ``max_series_rows`` are chunked (with a halo of ``back`` rows
    before and ``ahead`` after); all other assets keep the plain one-shuffle layout.
    """
    plain = SeriesLayout((asset,), tuple(order), False)
    if force_chunks is True:
        return [_chunk(df, asset, order, back, ahead, chunk_rows)]
    if force_chunks is False or max_series_rows is None:
        return [(df, plain)]
    hot, n_hot = hot_keys(df, asset, max_series_rows)
    if n_hot == 0:
        return [(df, plain)]
    cold_part = join_small(df, hot, asset, n_hot, "left_anti")
    hot_part = join_small(df, hot, asset, n_hot, "left_semi")
    return [(cold_part, plain), _chunk(hot_part, asset, order, back, ahead, chunk_rows, n_keys=n_hot)]


def running_totals(df: DataFrame, order: Sequence[Column | str], values: Sequence[str],
                   keys: Sequence[str] = (), suffix: str = "_cum", total_suffix: str = "_all",
                   n_parts: int | None = None) -> DataFrame:
    """Inclusive running sums of ``values`` along ``order`` (total order) inside ``keys``, and the
    key's totals (``total_suffix``).

    One path for every size: range partitions of (keys, order) are summed, the sums are turned
    into offsets (a table of at most keys + partitions rows), and each partition adds its own
    prefix. A key that holds most rows is spread over many partitions; null keys are keys.
    """
    keys = list(keys)
    n = _n_parts(df, n_parts)
    sort_cols = [*keys, *order]
    ranged = df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
    tagged = checkpointed(ranged.withColumn(_MID, F.monotonically_increasing_id())).withColumn(
        _PID, F.shiftright(F.col(_MID), 33))
    sums = tagged.groupBy(*keys, _PID).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    before = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = sums.select(
        *keys, _PID, *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in values],
        *[F.sum(f"_t_{v}").over(whole).alias(f"{v}{total_suffix}") for v in values])
    joined = join_small(tagged, offsets, [*keys, _PID], None if keys else n)
    inside = Window.partitionBy(*keys, _PID).orderBy(_MID).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(*df.columns, *[(F.sum(v).over(inside) + F.col(f"_o_{v}")).alias(f"{v}{suffix}") for v in values],
                         *[f"{v}{total_suffix}" for v in values])


def apply_series(df: DataFrame, asset: str, order: Sequence[str], back: int, ahead: int,
                 build: Callable[[DataFrame, SeriesLayout], DataFrame], **plan_kw) -> DataFrame:
    """Run ``build(df, layout)`` (window expressions) under the chosen layout(s)."""
    out = None
    for part, layout in plan_series(df, asset, order, back, ahead, **plan_kw):
        res = layout.finish(build(part, layout))
        out = res if out is None else out.unionByName(res)
    return out
