"""Telemetry readers: CSV (the reference's format) or Parquet, typed by column name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField, StructType,
                               TimestampNTZType)

from vigil.config import REFERENCE_SPEC, TelemetrySpec
from vigil.operators.wrangle import nan_to_null
from vigil.session import checkpointed


def reference_schema(spec: TelemetrySpec = REFERENCE_SPEC) -> StructType:
    """The 19-column layout of the reference's telemetry table."""
    fields = [StructField(spec.ts, TimestampNTZType(), False), StructField(spec.asset, IntegerType(), False)]
    fields += [StructField(c, StringType(), True) for c in spec.ids]
    fields += [StructField(c, DoubleType(), True) for c in spec.sensors + spec.context]
    if spec.regime:
        fields.append(StructField(spec.regime, IntegerType(), False))
    if spec.fault:
        fields.append(StructField(spec.fault, IntegerType(), False))
    fields += [StructField(c, StringType(), True) for c in spec.extra_labels]
    if spec.label:
        fields.append(StructField(spec.label, IntegerType(), False))
    return StructType(fields)


def _typed(df: DataFrame, schema: StructType) -> DataFrame:
    present = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in present]
    if missing:
        raise KeyError(f"columns missing from the input: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_telemetry(spark: SparkSession, path: str, fmt: str = "csv", schema: StructType | None = None,
                   spec: TelemetrySpec = REFERENCE_SPEC) -> DataFrame:
    """Read a telemetry table and type it by column *name* (CSV columns may come in any
    order). NaN readings become null. Parquet keeps its own types where they match."""
    schema = schema or reference_schema(spec)
    if fmt == "csv":
        raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    elif fmt == "parquet":
        raw = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    df = _typed(raw, schema)
    doubles = [f.name for f in schema.fields if isinstance(f.dataType, DoubleType)]
    return nan_to_null(df, doubles)


CORRUPT = "_corrupt_record"


def read_with_rejects(spark: SparkSession, path: str, schema: StructType | None = None, max_share: float = 0.001) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a CSV telemetry table: a bad row is set aside instead of ending the read.

    A row is rejected if it has too few or too many fields, or a field that is there but not of its column's type, or none where the
    schema allows no null. Rejects are (record, columns): the raw line or its fields as JSON, and the columns at fault
    (none for a broken line). More than ``max_share`` of all rows rejected raises ``ValueError``. Columns may
    come in any order; empty fields are null, as are NaN readings.
    """
    schema = schema or reference_schema()
    names = spark.read.option("header", True).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise KeyError(f"columns missing from the input: {missing}")
    text = StructType([*(StructField(c, StringType()) for c in names), StructField(CORRUPT, StringType())])
    # Read once into the shared folder: the corrupt-record column is not there if only it is asked for.
    raw = checkpointed(spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
                       .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    bad = F.filter(F.array(*[
        F.when((F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull())
               | (F.lit(not f.nullable) & F.col(f"`{f.name}`").isNull()), F.lit(f.name)) for f in schema.fields]), lambda c: c.isNotNull())
    judged = raw.withColumn("_bad", bad)
    wrong = F.col(CORRUPT).isNotNull() | (F.size("_bad") > 0)
    n = judged.agg(F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("bad")).first()
    if n["bad"] > max_share * n["n"]:
        raise ValueError(f"{n['bad']} of {n['n']} rows are unreadable; at most a share of {max_share} may be")
    record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])))
    rejects = judged.filter(wrong).select(record.alias("record"), F.when(F.col(CORRUPT).isNull(), F.col("_bad")).otherwise(F.array().cast("array<string>")).alias("columns"))
    good = judged.filter(~wrong).select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return nan_to_null(good, [f.name for f in schema.fields if isinstance(f.dataType, DoubleType)]), rejects


TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_telemetry_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and microsecond timestamps (Spark's default keeps milliseconds)."""
    (df.write.mode("overwrite").option("header", True).option("timestampFormat", TS_FORMAT)
       .option("timestampNTZFormat", TS_FORMAT).csv(path))
