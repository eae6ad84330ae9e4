"""Training-data pipeline over ``documents``: quality, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet below the
shared checkpoint folder and reads it again as the next stage's ``docs``, so a lost executor costs
tasks of one stage only. All stages but the last return the columns of their ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import decontaminate, line_dedup, packing, quality_classifier, simhash
from vigil.llm.common import carried, fold, read, unpacked
from vigil.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, rows and columns as they are. The model learns from the labelled rows of this
    stage's input.

    A null or empty text is scored as an empty one; a row without an id is scored, but not learnt from; repeated rows are
    all kept or all removed; without labels of both kinds every document stays.
    """
    return quality_classifier.accept(docs, read(spark, sf_dir, "labels"), fold("doc_id", 5, 0), threshold=0.3)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand in ten or more of them; n_chars, if there is one, counts what is left.

    Every row is a document, repeated ones too. A null text becomes an empty one. All other columns stay
    as they are, whatever their names: the operator sees the id, the text and one packed column.
    """
    packed = docs.select("doc_id", "text", carried(docs, ["doc_id", "text"]).alias("rest"))
    kept = line_dedup.dedup_lines(packed, min_docs=10, min_chars=1)
    own = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return kept.select(*unpacked(kept, "rest", docs.columns, own))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, all columns as they are.

    The smallest id stays, null ids last; of equal ids the text with the smallest hash, of equal rows one. Texts without
    words (null, empty, blank) are one group.
    """
    return simhash.one_of_each(docs, words_per_shingle=4, max_bits=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark, row by row: ids may be null or repeat; all columns as they are.

    A row's key is a 128-bit hash of its id and text; rows with equal keys are contaminated alike. Null and empty texts
    are clean.
    """
    key = F.concat_ws(":", F.xxhash64("doc_id", "text"), F.xxhash64(F.lit(1), "text", "doc_id"))
    keyed = docs.select(key.alias("doc_id"), "text")
    found = decontaminate.contamination(keyed, read(spark, sf_dir, "benchmark"), window=13, slop=0)
    dirty = found.filter("contaminated").select(F.col("doc_id").alias("dirty")).distinct()
    rows = docs.select(key.alias("key"), carried(docs, []).alias("row")).join(dirty, F.col("key") == F.col("dirty"), "left_anti")
    return rows.select(*unpacked(rows, "row", docs.columns, {}))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens.

    Null and empty texts are their end token; repeated rows and null ids are documents of their own. Only the operator's
    columns come out.
    """
    return packing.pack(docs, max_tokens=2048)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_duplicates),
          ("decontamination", decontaminated), ("packing", packed)]

#: The stages hold a learned model, 64-bit fingerprints by XXH64 and a tokenizer, which SQL has no words for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; returns the last one's rows."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
