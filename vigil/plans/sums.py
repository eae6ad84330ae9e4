"""Sums of fixed-length NumPy arrays over the rows of a table."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 32  # positions in a row of the tasks' sums


def array_sums(df: DataFrame, columns: Sequence[str], add: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``add(x)`` (an array of ``size``) over all rows, x being Arrow batches of ``columns`` as a matrix.

    A task yields rows of ``WIDTH`` neighbouring positions, Spark adds them up by row, and ``size`` numbers reach the driver.
    """
    names = [f"v{j}" for j in range(min(WIDTH, size))]
    n_rows = -(-size // len(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros(n_rows * len(names)), False
        for b in batches:
            if b.num_rows:
                any_row = True
                total[:size] += add(np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]))
        if any_row:
            table = total.reshape(n_rows, len(names))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_rows)), *(pa.array(np.ascontiguousarray(c)) for c in table.T)], names=["i", *names])

    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    sums = rows.mapInArrow(run, "i long, " + ", ".join(f"{n} double" for n in names)).groupBy("i")
    got = sums.agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    out = np.zeros((n_rows, len(names)))
    out[got["i"].to_numpy()] = np.column_stack([got[n].to_numpy() for n in names])
    return out.ravel()[:size]
