"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

Each task packs the examples it reads: an example longer than a sequence gives full sequences first;
what is left over is one vector (tokens, segments, loss-bearing tokens). Sequences are filled one by
one: among the examples that fit, the one whose vector has the largest dot product with the sequence's
free room, each dimension weighed by how scarce it is, goes in; when none fits whole, one is cut to
fill the room. No ids are shuffled. What a task cannot fill at its end is cut into power-of-two
lengths, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.bpe import byte_pairs
from vigil.llm.common import checkpointed

SCHEMA = ("doc_id string, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, "
          "part int, bin long, offset long, bin_length long")


def fill(need: np.ndarray, limits: np.ndarray) -> list[list[tuple[int, int]]]:
    """Sequences as lists of (example, tokens taken) for examples with need[i] = (tokens, segments, loss).

    The last sequence alone may be left unfilled where an example could still be cut. The tokens of an
    example that bear no loss are its first ones.
    """
    left = need.astype(np.float64).copy()
    alive = np.arange(len(left))
    scale = left.sum(axis=0) / limits
    weight = scale / max(scale.sum(), 1e-9) / limits ** 2
    out: list[list[tuple[int, int]]] = []
    while len(alive):
        room, row = limits.astype(np.float64).copy(), []
        here = left[alive]
        open_ = np.ones(len(alive), bool)
        while True:
            ok = open_ & (here <= room + 1e-9).all(axis=1)
            if ok.any():
                gain = np.where(ok, here @ (weight * room), -1.0)
                best = int(gain.argmax())
                row.append((int(alive[best]), int(here[best, 0])))
                room -= here[best]
                open_[best] = False
                continue
            # No example fits whole: cut the longest one so that the room is used up.
            if room[1] < 1 or not open_.any():
                break
            best = int(np.where(open_, here[:, 0], -1).argmax())
            quiet = here[best, 0] - here[best, 2]
            take = int(min(room[0], room[2] + quiet, here[best, 0] - 1))
            if take < 1:
                break
            cut = np.array([take, 1, max(0.0, take - quiet)])
            row.append((int(alive[best]), take))
            left[alive[best]] = here[best] - cut * (1, 0, 1)
            break
        if not row:
            raise ValueError("an example does not fit an empty sequence")
        out.append(row)
        alive = alive[open_]
    return out


def powers(n: int) -> list[int]:
    """n as powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(docs: DataFrame, max_tokens: int = 2048, max_segments: int = 256, max_loss: int | None = None, end_id: int = 1,
         tokenizer: str | None = None, group: int = 2000, id_col: str = "doc_id", text_col: str = "text",
         loss_col: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, loss_tokens, sequence_id, offset, sequence_length.

    ``loss_col`` names a boolean column that tells whether an example's tokens bear loss (instruction
    data: prompts don't); without it every token but an example's first does. ``group`` examples are
    packed together, and the last unfilled sequence of a group goes on into the next one, so a task's
    memory is bounded. sequence_id runs from 0 without gaps.

    Defined cases: a null or empty text has the end id alone; ids may be null or repeat, each row is
    an example of its own; a text of any length is cut; an empty table gives an empty one; other
    columns are not read.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    limits = np.array([max_tokens, max_segments, max_loss or max_tokens])
    group = max(group, 4 * max_segments)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, pairs, next_bin = TaskContext.get().partitionId(), byte_pairs(path), 0
        waiting: list[list] = []  # [doc_id, ids, start, doc_tokens, bears loss]
        rows: list[tuple] = []

        def emit(pieces: list[tuple[list, int]], length: int) -> None:
            nonlocal next_bin
            at = 0
            for e, take in pieces:
                ids, begin = e[1][:take], e[2]
                loss = take - (begin == 0) if e[4] else 0
                rows.append((e[0], begin, take, zlib.crc32(ids.astype("<u4").tobytes()), e[3], loss, part, next_bin, at, length))
                e[1], e[2] = e[1][take:], begin + take
                at += take
            next_bin += 1

        def flush(last: bool) -> None:
            nonlocal waiting
            if not waiting:
                return
            need = np.array([(len(e[1]), 1, len(e[1]) - (e[2] == 0) if e[4] else 0) for e in waiting])
            bins = fill(need, limits)
            for k, b in enumerate(bins):
                total = sum(t for _, t in b)
                if k == len(bins) - 1 and total < max_tokens:
                    tail = [waiting[i] for i, _ in b]
                    if not last:
                        waiting = tail
                        return
                    for size in powers(total):
                        pieces, room = [], size
                        while room:
                            take = min(room, len(tail[0][1]))
                            pieces.append((tail[0], take))
                            room -= take
                            if take == len(tail[0][1]):
                                tail = tail[1:]
                        emit(pieces, size)
                    break
                emit([(waiting[i], t) for i, t in b], total)
            waiting = []

        for x in batches:
            for doc_id, text, loss in zip(x["doc_id"], x["text"], x["loss"]):
                ids = np.append(pairs.array(text or ""), end_id)
                # What bears loss is cut so that no piece goes beyond the loss limit.
                most = int(min(limits[0], limits[2])) if loss else max_tokens
                for begin in range(0, len(ids), most):
                    e = [doc_id, ids[begin: begin + most], begin, len(ids), loss]
                    if len(e[1]) == max_tokens:
                        emit([(e, max_tokens)], max_tokens)
                    else:
                        waiting.append(e)
                if len(waiting) >= group:
                    flush(False)
            if rows:
                yield frame(rows)
                rows = []
        flush(True)
        if rows:
            yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    # Ids travel as text: pandas would turn a long column with nulls into floats.
    kind = docs.schema[id_col].dataType
    read = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"),
                       (F.coalesce(F.col(loss_col), F.lit(False)) if loss_col else F.lit(True)).alias("loss"))
    pieces = checkpointed(read.mapInPandas(run, SCHEMA))
    # One count for each task goes to the driver, for gapless sequence ids.
    counts = sorted(pieces.groupBy("part").agg(F.max("bin").alias("b")).collect())
    before, total = [], 0
    for p, b in counts:
        before.append((p, total))
        total += b + 1
    offsets = docs.sparkSession.createDataFrame(before or [(0, 0)], "part int, before long")
    return (pieces.join(F.broadcast(offsets), "part")
            .select(F.col("doc_id").cast(kind).alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("bin")).alias("sequence_id"),
                    "offset", "loss_tokens", F.col("bin_length").alias("sequence_length")))
