"""Packing token sequences into windows by minimum bin slack.

Each document's ids are cut into full windows and a rest. Rests wait in a pool, as counts by length. For each window, subset-sum dynamic
programming over a bitset of reachable fills (bit s: some multiset of waiting lengths adds up to s) runs from the longest rest down until
the capacity is reached or all lengths have been seen; the highest reachable bit is the least slack, and walking back through the bitsets
gives how many of each length fill it. Partitions pack on their own as their rows stream by; what a partition can't fill closely is packed
once more with the rests of other partitions.

Null text is empty: its single piece is the end id. Rows may repeat and ids may be null: each row is packed as a document of its own.
An empty table gives no piece. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import TEXT_ROWS, materialize
from .common import frame_steps, give_back, reachable, table
from .tokens import MOST_CHUNKS, encoder, tokenizer_path

CAPACITY = 4096
END_ID = 2
#: Rests that wait before windows are filled; at least this many are kept for good fills until the partition ends.
POOL = 2_048
#: A partition passes windows with more slack than this on to the second packing.
CLOSE = 8
#: Chunks whose ids a worker keeps in the pipeline.
STAGE_CHUNKS = 100_000
#: Partitions whose rests are packed together.
TOGETHER = 64
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each waiting length to take so that their sum is as near to the capacity as any multiset comes, not over it."""
    mask = (1 << capacity + 1) - 1
    reached, steps = 1, []
    for length in sorted(counts, reverse=True):
        for _ in range(min(counts[length], capacity // length)):
            grown = (reached | reached << length) & mask
            if grown == reached:
                break
            steps.append((length, reached))
            reached = grown
        if reached >> capacity:
            break
    at, taken = reached.bit_length() - 1, defaultdict(int)
    for length, before in reversed(steps):
        if not before >> at & 1:
            taken[length] += 1
            at -= length
    return taken


class Packer:
    """Fills windows from a pool of rests; a rest is any tuple, known by its length."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.waiting: dict[int, list[tuple]] = defaultdict(list)
        self.number = 0

    def add(self, length: int, rest: tuple) -> None:
        self.waiting[length].append(rest)
        self.number += 1

    def fill(self, slack: int) -> list[tuple[tuple, int, int]] | None:
        """(rest, sequence id, offset) of one more window, or None if none has so little slack."""
        taken = best_fill({k: len(v) for k, v in self.waiting.items()}, self.capacity)
        if not taken or self.capacity - sum(k * n for k, n in taken.items()) > slack:
            return None
        out, offset = [], 0
        for length, n in taken.items():
            for _ in range(n):
                out.append((self.waiting[length].pop(), self.next_id, offset))
                offset += length
            if not self.waiting[length]:
                del self.waiting[length]
        self.number -= len(out)
        self.next_id += 1
        return out

    def rest(self) -> list[tuple]:
        return [r for v in self.waiting.values() for r in v]


def _packed(encode: Callable[[list[str]], list[bytes]], capacity: int, end_id: int, kept_chunks: int):
    end = np.array([end_id], dtype="<u4").tobytes()
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        part = TaskContext.get().partitionId()
        packer = Packer(capacity, part << 32)
        for rows, texts in frame_steps(batches):
            out = []
            for doc_id, ids in zip(rows["doc_id"], encode(texts), strict=True):
                ids += end
                total = len(ids) // 4
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    row = (doc_id, start, len(piece) // 4, zlib.crc32(piece), total)
                    if row[2] == capacity:
                        out.append((*row, packer.next_id, 0))
                        packer.next_id += 1
                    else:
                        packer.add(row[2], row)
            while packer.number > POOL:
                out += [(*r, s, o) for r, s, o in packer.fill(capacity)]
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
        out = []
        while (window := packer.fill(CLOSE)) is not None:
            out += [(*r, s, o) for r, s, o in window]
        if kept_chunks < MOST_CHUNKS:
            encoder.cache_clear()
            give_back()
        out += [(*r, None, part) for r in packer.rest()]  # the partition's number stands in for the offset
        yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64", "sequence_id": "Int64"})

    return run


def _together(capacity: int):
    def run(key: tuple, rests: pd.DataFrame) -> pd.DataFrame:
        packer = Packer(capacity, (1 << 61) + (int(key[0]) << 32))
        names = list(rests.columns)
        for row in rests.sort_values(["offset", "doc_id", "start"]).astype(object).itertuples(index=False):
            packer.add(int(row.length), (None if pd.isna(row.doc_id) else int(row.doc_id), *row[1:5]))
        out = []
        while (window := packer.fill(capacity)) is not None:
            out += [(*r, s, o) for r, s, o in window]
        return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return run


def pack(documents: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, kept_chunks: int = MOST_CHUNKS, markers: bool = False) -> DataFrame:
    """A row per piece: where it lies in its document and in its sequence.

    kept_chunks bounds the ids that a worker remembers; fewer take less memory and more time, the result is the same. With markers, special tokens' strings in a text become special ids. Sequence ids are unique, not dense. Texts are tokenized once; pieces are written to the shared folder, and the second packing
    reads the few rests of each partition from there.
    """
    reachable(documents.sparkSession)
    path = tokenizer or tokenizer_path("word_bpe_49k.json")

    def encode(texts: list[str]) -> list[bytes]:
        return encoder(path, kept_chunks, markers).encode(texts)

    pieces = materialize(documents.select("doc_id", "text").mapInPandas(_packed(encode, capacity, end_id, kept_chunks), PIECES), "packing", TEXT_ROWS)
    placed = pieces.where(F.col("sequence_id").isNotNull())
    rests = pieces.where(F.col("sequence_id").isNull())
    return placed.unionByName(rests.groupBy(F.floor(F.col("offset") / TOGETHER)).applyInPandas(_together(capacity), PIECES))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), markers=True)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of all documents. Its workers still hold memory of the stages before, so they keep fewer chunks."""
    return pack(docs, kept_chunks=STAGE_CHUNKS, markers=True)
