"""Secret scans with corpus-wide ownership frequency.

One pass finds the spans: the three base kinds, and ``opaque`` candidates (long mixed tokens outside
them). The candidates' hashes are then aggregated over the whole corpus by distinct repositories and
distinct owners. A value that many owners hold, or many repositories for the size of its owners, is a copied
example; a value that few hold and that looks random is a live credential. Only live opaque candidates are added to the spans. What moves
between tasks is one narrow row per candidate, never text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import checkpointed

KINDS = ("assign", "access", "hex", "opaque")

# The patterns of the base kinds. They run on bytes; ``assign`` runs on the lower-cased
# text (its keywords may have either case, and lower-casing A-Z keeps every length).
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")
OPAQUE = re.compile(rb"[A-Za-z0-9+/_=-]{20,}")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api")


def _runs(pattern_bytes: bytes) -> bytes:
    return bytes(120 if b in pattern_bytes else 32 for b in range(256))


_HEX_RUN = _runs(b"0123456789abcdef")
_OPAQUE_RUN = _runs(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")


def entropy(value: bytes) -> float:
    """Bits per byte of the value's own byte frequencies."""
    n = np.bincount(np.frombuffer(value, np.uint8))
    p = n[n > 0] / len(value)
    return float(-(p * np.log2(p)).sum())


def spans(text: bytes) -> list[tuple[str, int, int, bytes]]:
    """(kind, start, end, value) in code points; leftmost, non-overlapping per kind, in order."""
    found: list[tuple[int, int, int, bytes]] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end(), text[m.start(2): m.end(2)]) for m in ASSIGN.finditer(low) if m.end(2) - m.start(2) >= 12]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text)]
    if b"x" * 16 in text.translate(_HEX_RUN):
        found += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    if b"x" * 20 in text.translate(_OPAQUE_RUN):
        base = [(a, b) for a, _, b, _ in found]
        for m in OPAQUE.finditer(text):
            v = m.group()
            mixed = re.search(rb"[0-9]", v) and re.search(rb"[A-Za-z]", v)
            if mixed and all(m.end() <= a or m.start() >= b for a, b in base):
                found.append((m.start(), 3, m.end(), v))
    # Code points before each offset, counted once from one to the next.
    at, n, last = {}, 0, 0
    for i in sorted({i for a, _, b, _ in found for i in (a, b)}):
        n += len(text[last:i].decode("utf-8", "replace"))
        at[i], last = n, i
    return [(KINDS[k], at[a], at[b], v) for a, k, b, v in sorted(found)]


FOUND = ("doc_id string, owner string, repo string, n_assign long, n_access long, n_hex long, "
         "found array<struct<at:int,kind:string,start:long,end:long,hash:string,random:boolean>>")


def find(docs: DataFrame, min_entropy: float = 3.0, id_col: str = "doc_id", text_col: str = "text",
         repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """One row per document with its counts and spans, before anything is known of other documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = []
            for doc_id, owner, repo, text in zip(x["doc_id"], x["owner"], x["repo"], x["text"]):
                got = spans(b"" if text is None else bytes(text))
                kinds = [g[0] for g in got]
                rows.append((doc_id, owner, repo, *(kinds.count(k) for k in KINDS[:3]), [
                    {"at": i, "kind": k, "start": a, "end": b, "hash": hashlib.md5(v).hexdigest(), "random": entropy(v) >= min_entropy}
                    for i, (k, a, b, v) in enumerate(got)]))
            yield pd.DataFrame(rows, columns=["doc_id", "owner", "repo", "n_assign", "n_access", "n_hex", "found"])

    text = lambda c: F.col(c).cast("string")
    return docs.select(text(id_col).alias("doc_id"), text(owner_col).alias("owner"), text(repo_col).alias("repo"),
                       F.col(text_col).cast("binary").alias("text")).mapInPandas(run, FOUND)


def scan(docs: DataFrame, max_owners: int = 2, max_repos: int = 20, min_entropy: float = 3.0, id_col: str = "doc_id", text_col: str = "text",
         repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, and ``spans``, an array of
    (at, kind, start, end, hash, n_repos, n_owners, verdict) in order of start, then kind.

    The verdict is ``example`` for a value held by more than ``max_owners`` owners, or by more repositories than
    ``max_repos`` and the square root of all repositories its owners have, added; else ``live`` if it
    looks random (``min_entropy`` bits a byte), else ``weak``. Base spans stay whatever their verdict;
    opaque ones stay if live.

    Defined cases: a null text is empty; all null owners count as one owner, all null repositories as
    one repository; ids may be null or repeat, each row is a document of its own; an empty table
    gives an empty one; other columns are not read.
    """
    kind = docs.schema[id_col].dataType
    rows = checkpointed(find(docs, min_entropy, id_col, text_col, repo_col, owner_col)
                        .withColumn("row", F.monotonically_increasing_id()))
    each = rows.select("row", "owner", "repo", F.explode("found").alias("f")).select("row", "owner", "repo", "f.*")
    # A value that one owner holds in a third of all rows becomes one row per (hash, owner, repo) and task first.
    named = each.select("hash", F.coalesce("owner", F.lit("\x00")).alias("owner"), F.coalesce("repo", F.lit("\x00")).alias("repo"))
    holders = named.select("hash", "owner").distinct()
    owners = holders.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"))
    repos = named.select("hash", "repo").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n_repos"))
    known = checkpointed(owners.join(repos, "hash"))
    # Only values that are wide for the smallest owner need the size of theirs.
    held = (rows.select(F.coalesce("owner", F.lit("\x00")).alias("owner"), F.coalesce("repo", F.lit("\x00")).alias("repo")).distinct()
            .groupBy("owner").agg(F.count(F.lit(1)).alias("held")))
    wide = known.filter((F.col("n_repos") > max_repos) & (F.col("n_owners") <= max_owners)).select("hash")
    sizes = holders.join(wide, "hash").join(held, "owner").groupBy("hash").agg(F.sum("held").alias("held"))
    known = checkpointed(known.join(sizes, "hash", "left"))
    copied = F.col("n_repos") > max_repos + F.sqrt(F.coalesce("held", F.lit(0)))
    verdict = F.when((F.col("n_owners") > max_owners) | copied, "example").when(F.col("random"), "live").otherwise("weak")
    judged = (each.drop("owner", "repo").join(known, "hash").withColumn("verdict", verdict)
              .filter((F.col("kind") != "opaque") | (F.col("verdict") == "live")))
    one = F.struct("at", "kind", "start", "end", "hash", "n_repos", "n_owners", "verdict")
    back = judged.groupBy("row").agg(F.array_sort(F.collect_list(one)).alias("spans"))
    none = F.array().cast("array<struct<at:int,kind:string,start:bigint,end:bigint,hash:string,n_repos:bigint,n_owners:bigint,verdict:string>>")
    return (rows.drop("found", "owner", "repo").join(back, "row", "left")
            .select(F.col("doc_id").cast(kind).alias("doc_id"), "n_assign", "n_access", "n_hex",
                    F.coalesce("spans", none).alias("spans")))
