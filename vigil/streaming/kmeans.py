"""Online k-means over a stream: one mini-batch update per micro-batch, centres and counts in a state table.

The state table is partitioned by batch number. A batch reads the state of the latest batch before its own
and writes its own partition, so a batch that is replayed after a failure gives the same centres.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.vector import nearest
from vigil.operators.score import CentroidModel
from vigil.sources.store import missing_path

BATCH = "batch"


def read_centres(spark: SparkSession, state: str, cols: Sequence[str], before: int | None = None) -> tuple[CentroidModel, list[int]] | None:
    """(centres, rows seen by each) after the last batch, or the last one before ``before``; None if there is none."""
    try:
        table = spark.read.parquet(state)
    except AnalysisException as ex:
        if missing_path(ex):
            return None
        raise
    table = table if before is None else table.filter(F.col(BATCH) < before)
    last = table.agg(F.max(BATCH)).first()[0]
    if last is None:
        return None
    rows = sorted(table.filter(F.col(BATCH) == last).collect(), key=lambda r: r["cid"])  # K rows
    return CentroidModel(tuple(cols), tuple(tuple(float(r[c]) for c in cols) for r in rows), "online"), [int(r["n"]) for r in rows]


def update_centres(rows: DataFrame, batch_id: int, start: CentroidModel, state: str) -> None:
    """One batch: each centre moves to the mean of all rows that it has been given, this batch's under the old centres.
    Rows with a null component are left out; a batch without rows leaves the state as it is."""
    spark, cols = rows.sparkSession, start.columns
    known = read_centres(spark, state, cols, before=batch_id)
    model, seen = known or (start, [0] * start.k)
    points = rows.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    got = (points.groupBy(nearest(cols, model.centres).getField("cluster").alias("cid"))
           .agg(F.count(F.lit(1)).alias("m"), *[F.sum(c).alias(c) for c in cols]).collect())  # at most K rows
    if not got:
        return
    centres = [list(c) for c in model.centres]
    seen = list(seen)
    for r in got:
        i, m = int(r["cid"]), int(r["m"])
        centres[i] = [(seen[i] * c + float(r[x])) / (seen[i] + m) for c, x in zip(centres[i], cols)]
        seen[i] += m
    out = spark.createDataFrame([(i, seen[i], *c) for i, c in enumerate(centres)], "cid int, n long, " + ", ".join(f"`{c}` double" for c in cols))
    out.coalesce(1).write.mode("overwrite").parquet(f"{state}/{BATCH}={batch_id}")


def stream_kmeans(stream: DataFrame, start: CentroidModel, state: str, checkpoint_location: str):
    """Start the query that keeps the state table up to date with ``stream``."""
    return (stream.writeStream.foreachBatch(lambda rows, batch_id: update_centres(rows, batch_id, start, state))
            .option("checkpointLocation", checkpoint_location).start())
