"""Helpers shared by the corpus operators: null-safe columns, row keys, lineage cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import checkpointed

__all__ = ["SPACE", "UPPER", "LOWER", "ascii_lower", "carried", "checkpointed", "fold", "read", "row_number",
           "text_or_empty", "unpacked"]

# White space of the word rule [^\x20\x09-\x0D]+ : the same six characters that bytes.split() uses.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; other letters stay (``lower`` would change them too)."""
    return F.translate(col, UPPER, LOWER)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fold(id_col: str, parts: int, held: int) -> Column:
    """True where crc32 of the id as text leaves ``held`` modulo ``parts``; a null id is False."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == held, F.lit(False))


def carried(df: DataFrame, used: Sequence[str]) -> Column:
    """All other columns as one struct, so that no name of theirs can clash with a helper's."""
    rest = [c for c in df.columns if c not in used]
    return F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("none")])


def unpacked(df: DataFrame, packed: str, columns: Sequence[str], own: dict[str, Column]) -> list[Column]:
    """The columns named in ``columns``, in order: from ``own`` where given, else out of the struct."""
    return [(own[c] if c in own else F.col(packed).getField(c)).alias(c) for c in columns]


def row_number(df: DataFrame, order: Sequence[str], name: str) -> tuple[DataFrame, int]:
    """``df`` with global row numbers 0..N-1 along ``order``, and N.

    A range shuffle spreads the rows (ties go on by arrival, so that one repeated key does not fill
    one task); the sorted rows are written once, and only one count per partition reaches the driver.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    tie = "_rn_tie"
    ranged = (df.withColumn(tie, F.monotonically_increasing_id())
              .repartitionByRange(parts, *order, tie).sortWithinPartitions(*order, tie).drop(tie))
    at = checkpointed(ranged.withColumn("_rn_id", F.monotonically_increasing_id()))
    part = F.shiftright("_rn_id", 33)
    counts = sorted(at.groupBy(part.alias("p")).count().collect())
    before, total = [], 0
    for p, n in counts:
        before.append((int(p), total))
        total += n
    if not before:
        return at.withColumn(name, F.col("_rn_id")).drop("_rn_id"), 0
    offsets = spark.createDataFrame(before, "_rn_p int, _rn_before long")  # one row per partition
    numbered = (at.withColumn("_rn_p", part.cast("int")).join(F.broadcast(offsets), "_rn_p")
                .withColumn(name, F.col("_rn_before") + F.col("_rn_id").bitwiseAND(F.lit((1 << 33) - 1))))
    return numbered.drop("_rn_p", "_rn_before", "_rn_id"), total
