"""Spark session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "16g",
                  app: str = "vigil", extra: dict | None = None) -> SparkSession:
    """A local[N] session configured like the cluster jobs expect (UTC, AQE, no UI)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", memory))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (shared storage); only a local-mode session
    without one gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="vigil-ckpt-", dir=os.environ.get("VIGIL_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def checkpointed(df):
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used where one physical result must be read twice consistently (positional index) and
    before iterative fits; a lost executor re-reads the files instead of recomputing.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
