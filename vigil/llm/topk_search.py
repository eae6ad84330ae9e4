"""Exact top-k by inner product with Fagin's threshold algorithm.

Vectors are made whole numbers, floor(scale * x). The candidates of a task are cut into blocks of
vectors that lie near each other, and every block keeps one sorted list per dimension. For a query, a list is read from
its high end where the query's component is positive and from its low end where it is negative. After t
reads of each list no unread vector can score more than the threshold

    sum over dimensions of query[d] * (value at depth t of list d),

so a block is left when its threshold cannot beat the query's kth result so far. The threshold at depth 0
ranks the blocks: the most promising comes first, and the rest are not opened once the best of them falls
short. A block whose lists have all but been read is scored to its end.

Queries go out in blocks of a fixed number of rows, each against all rows; tasks keep k results a query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import checkpointed

NO_ID = np.iinfo(np.int64).max  # sorts null ids last
BLOCK = 2048
SPAN = 32_768  # candidates whose lists a task holds at once
FIRST_DEPTH = 4  # then four times as deep each time
FOUND = "query long, query_id long, row long, vec_id long, score long"


def matrix(vectors: pa.ListArray, scale: int, width: int = 0) -> np.ndarray:
    """floor(scale * x) of a list array, as whole numbers in doubles; short vectors are followed by zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    width = max(width, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def whole(x: np.ndarray) -> np.ndarray:
    """The same numbers as Python's integers, for scores beyond 53 bits."""
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


class Block:
    """Vectors with a sorted list per dimension."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        self.x, self.ids, self.rows = x, ids, rows
        self.order = np.argsort(x, axis=0, kind="stable").T.astype(np.int32)  # dimension, depth from the low end
        self.value = np.take_along_axis(x.T, self.order, axis=1)

    def threshold(self, q: np.ndarray, t: int):
        """What no vector outside the first t of each list exceeds."""
        n = len(self.x)
        return np.where(q > 0, q * self.value[:, n - t - 1], q * self.value[:, t]).sum()


class Best:
    """The k best results of one query so far: highest score first, then the smallest id."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score, self.ids, self.rows = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def kth(self):
        return self.score[-1] if len(self.score) == self.k else None

    def add(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if self.kth is not None:
            on = score >= self.kth
            if not on.any():
                return
            score, ids, rows = score[on], ids[on], rows[on]
        elif score.dtype != object and len(score) > 4 * self.k:
            on = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids, rows = score[on], ids[on], rows[on]
        score, ids, rows = np.concatenate((self.score, score)), np.concatenate((self.ids, ids)), np.concatenate((self.rows, rows))
        first = np.lexsort((rows, ids, -score)) if score.dtype != object else np.array(
            sorted(range(len(score)), key=lambda i: (-score[i], ids[i], rows[i])), int)
        first = first[: self.k]
        self.score, self.ids, self.rows = score[first], ids[first], rows[first]


def search(block: Block, q: np.ndarray, own_row: int, best: Best) -> int:
    """The threshold algorithm over one block; returns how many vectors were scored."""
    n, seen = len(block.x), np.zeros(len(block.x), bool)
    used = np.flatnonzero(q != 0)
    high = used[q[used] > 0]
    low = used[q[used] < 0]
    t = FIRST_DEPTH
    while True:
        new = ~seen
        if len(used) and 2 * t * len(used) < n:
            touched = np.zeros(n, bool)
            touched[block.order[high, n - t:]] = True
            touched[block.order[low, :t]] = True
            new &= touched
        else:
            t = n  # the lists hold nearly all vectors by now: read them to the end
        at = np.flatnonzero(new & (block.rows != own_row))
        best.add(block.x[at] @ q, block.ids[at], block.rows[at])
        seen |= new
        # An unread vector with the kth score could have a smaller id, so equality goes on.
        if t == n or best.kth is not None and block.threshold(q, t) < best.kth:
            break
        t *= 4
    return int(seen.sum())


def blocks(x: np.ndarray, ids: np.ndarray, rows: np.ndarray, size: int = BLOCK) -> list[Block]:
    """Cut into blocks of near vectors: ordered by the nearest of a few of them."""
    if len(x) > size and x.dtype != object:
        pivots = x[:: max(1, len(x) // 64)][:64]
        near = (x @ pivots.T - 0.5 * (pivots ** 2).sum(axis=1)[None]).argmax(axis=1)
        order = np.argsort(near, kind="stable")
        x, ids, rows = x[order], ids[order], rows[order]
    return [Block(x[i: i + size], ids[i: i + size], rows[i: i + size]) for i in range(0, len(x), size)]


def best_of(span: list[Block], queries: np.ndarray, own_rows: np.ndarray, best: list[Best]) -> int:
    """All queries against the blocks, for each the most promising first; returns how many vectors were scored."""
    top, bottom = (np.stack([b.value[:, i] for b in span]) for i in (-1, 0))
    most = np.maximum(queries, 0) @ top.T + np.minimum(queries, 0) @ bottom.T  # thresholds at depth 0
    scored = 0
    for i, row in enumerate(own_rows):
        for b in sorted(range(len(span)), key=lambda j: -most[i, j]):
            if best[i].kth is not None and most[i, b] < best[i].kth:
                break
            scored += search(span[b], queries[i], row, best[i])
    return scored


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding",
          query_rows: int = 16_384) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest inner product for each row that ``is_query`` names,
    of floor(scale * component), ties to the smaller id.

    The rows are written once, numbered; each pass takes at most ``query_rows`` queries (that, times a vector's
    size, bounds what is broadcast) against all rows, and its results are written before the next. A task holds ``SPAN``
    vectors and k results for each query of the pass.

    Defined cases: a vector that is null, or holds a null, NaN or infinite component (also if it is so only after scaling),
    takes no part. Other rows are candidates of every query but of themselves, by row and not by id: a repeated row is another row,
    and each repetition of a query gets results of its own. A null id is no query; as a candidate it comes after all other ids.
    ``is_query`` null is False. A vector shorter than another counts as zero where it ends; an empty one scores 0.
    Scores are exact; what does not fit into 64 bits is returned as the nearest number that does. Fewer candidates than k give them all; an empty table
    gives an empty one; other columns are not read.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float("inf")))
    rows = checkpointed(vectors.filter(v.isNotNull() & finite)
                        .select(F.col(id_col).cast("long").alias("id"), v.alias("v"),
                                (F.coalesce(is_query, F.lit(False)) & F.col(id_col).isNotNull()).alias("is_query"))
                        .withColumn("row", F.monotonically_increasing_id()))
    queries = checkpointed(rows.filter("is_query").select("id", "v", "row"))
    part = F.spark_partition_id()
    sizes = queries.groupBy(part.alias("p")).count().collect()  # one row per partition
    passes = []
    for at in range(0, sum(r["count"] for r in sizes), query_rows):
        passes.append(_one_pass(rows, _numbered(queries, sizes, at, query_rows), k, scale))
    if not passes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return (reduce(DataFrame.unionAll, passes).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _numbered(queries: DataFrame, sizes: list, at: int, n: int) -> pa.Table:
    """The queries number ``at`` to ``at + n - 1``, along the partitions of their written table."""
    before, wanted = 0, []
    for r in sorted(sizes):
        first, last = max(at - before, 0), min(at + n - before, r["count"])
        if first < last:
            wanted.append((int(r["p"]), first, last))
        before += r["count"]
    spans = {p: (a, b) for p, a, b in wanted}

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first, last = spans.get(TaskContext.get().partitionId(), (0, 0))
        done = 0
        for b in batches:
            some = b.slice(max(first - done, 0), max(0, min(last - done, b.num_rows) - max(first - done, 0)))
            done += b.num_rows
            if some.num_rows:
                yield some

    return queries.mapInArrow(take, queries.schema).toArrow()


def _one_pass(rows: DataFrame, queries: pa.Table, k: int, scale: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(queries.combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        q = matrix(asked["v"].chunk(0), scale)
        own = asked["row"].to_numpy()
        best = [Best(k) for _ in own]
        held: list[pa.RecordBatch] = []

        def answer() -> None:
            nonlocal q
            t = pa.Table.from_batches(held).combine_chunks()
            x = matrix(t["v"].chunk(0), scale, q.shape[1])
            if x.shape[1] > q.shape[1]:
                q = np.concatenate((q, np.zeros((len(q), x.shape[1] - q.shape[1]), q.dtype)), axis=1)
            ids = t["id"].fill_null(NO_ID).to_numpy()
            size = lambda a: float(max((abs(v) for v in (a.max(initial=0), a.min(initial=0)))))
            exact = size(x) * size(q) * max(x.shape[1], 1) < 2.0 ** 53
            best_of(blocks(x if exact else whole(x), ids, t["row"].to_numpy()), q if exact else whole(q), own, best)

        n = 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= SPAN:
                answer()
                held, n = [], 0
        if n:
            answer()
        m = [len(f.score) for f in best]
        if sum(m):
            least, most = np.iinfo(np.int64).min, NO_ID
            ids = np.concatenate([f.ids for f in best])
            score = [min(max(int(x), least), most) for f in best for x in f.score]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(own, m)), pa.array(np.repeat(asked["id"].to_numpy(), m)), pa.array(np.concatenate([f.rows for f in best])),
                 pa.array(ids, mask=ids == NO_ID), pa.array(score, pa.int64())], names=[c.split()[0] for c in FOUND.split(", ")])

    out = checkpointed(rows.select("id", "v", "row").mapInArrow(run, FOUND))
    sent.destroy()
    return out
