"""Line dedup: lines whose key stands in many documents are removed from all of them.

Native DataFrame operations only. Three passes read the text: one counts documents per line hash
(distinct inside the row, summed map-side before the shuffle), one finds the positions of frequent
lines, one puts the other lines together again by position. Between them only hashes and positions
move; the text itself moves once, with the positions its row loses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import SPACE, ascii_lower, carried, checkpointed, text_or_empty, unpacked

#: Frequent line hashes up to this many (16 bytes each) are broadcast after they have been counted;
#: more of them are joined by a shuffle that adaptive execution may split.
BROADCAST_HASHES = 1_000_000


def _keys(text: Column) -> Column:
    return F.split(ascii_lower(text), "\n")


def _hash(key: Column) -> Column:
    """128 bits, so that two different keys do not meet even among 10^12 lines."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text") -> DataFrame:
    """(a, b) hashes of the keys that stand in at least ``min_docs`` rows of ``docs``."""
    keys = F.transform(_keys(text_or_empty(text_col)), lambda x: F.btrim(x, F.lit(SPACE)))
    own = F.array_distinct(F.filter(keys, lambda x: F.length(x) >= min_chars))
    hashed = docs.select(F.explode(own).alias("key")).select(_hash(F.col("key")).alias("h")).select("h.a", "h.b")
    return (hashed.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_docs).select("a", "b"))


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with frequent lines removed from the text, and ``n_lines`` and ``n_dropped`` (long) added.

    A line ends at \\n; its key is the line without white space at its ends, A-Z lower-cased. Every
    row counts as one document. Defined cases: a null or empty text is one empty line and comes out
    as an empty text; keys shorter than ``min_chars`` code points always stay; a repeated row keeps
    its repetitions and each counts; null ids are ids like any other; an empty table gives an empty
    one; extra columns are carried through, and columns named n_lines or n_dropped are replaced.
    """
    gone = checkpointed(frequent_lines(docs, min_docs, min_chars, text_col))
    if gone.count() <= BROADCAST_HASHES:
        gone = F.broadcast(gone)
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), carried(docs, [id_col, text_col]).alias("_rest"))
    # The row's key is made of id and text: equal rows lose the same positions.
    keyed = rows.withColumns({"_k": F.xxhash64("_id", "_text"), "_m": F.xxhash64(F.lit(1), "_text", "_id")})
    lines = (keyed.select("_k", "_m", F.posexplode(_keys(F.col("_text"))).alias("pos", "key"))
             .withColumn("key", F.btrim("key", F.lit(SPACE))).filter(F.length("key") >= min_chars)
             .select("_k", "_m", "pos", _hash(F.col("key")).alias("h")).select("_k", "_m", "pos", "h.a", "h.b"))
    lost = lines.join(gone, ["a", "b"]).groupBy("_k", "_m").agg(F.collect_set("pos").alias("_gone"))
    both = (keyed.join(lost, ["_k", "_m"], "left")
            .withColumn("_lines", F.split("_text", "\n"))
            .withColumn("_n", F.size("_lines"))
            .withColumn("_gone", F.coalesce("_gone", F.array().cast("array<int>"))))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.col("_n") - 1), F.col("_gone")),
                       lambda i: F.element_at(F.col("_lines"), i + 1))
    body = F.when(F.size("_gone") == 0, F.col("_text")).otherwise(F.array_join(kept, "\n"))
    added = ["n_lines", "n_dropped"]
    own = {id_col: F.col("_id"), text_col: body,
           "n_lines": F.col("_n").cast("long"), "n_dropped": F.size("_gone").cast("long")}
    return both.select(*unpacked(both, "_rest", [c for c in docs.columns if c not in added] + added, own))
