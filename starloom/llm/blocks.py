"""Blocks of documents and the keys they use: what occurs in a block is listed once, and a value computed once a key comes back to its block.

Rows of a block table are (block, k, key, ...): k numbers the distinct keys of the block from 0. A block's own row has k = -1. A key that many
blocks use has one row a block; those of more than a share of all rows are spread over salts before they meet the key's single value.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text after which a block is closed; a longer document closes its own.
BLOCK_CHARS = 1 << 22
#: A key is hot if it has more than one in SHARE of all rows, so at most SHARE keys are, and at least HOT_ROWS rows.
SHARE = 1000
HOT_ROWS = 10_000
SALTS = 64


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative numbers as bytes, seven bits each, lowest first, the highest bit on all but a number's last byte; and where each number ends."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        more = values >= np.uint64(1 << bits)
        if not more.any():
            break
        size += more
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for j in range(int(size.max(initial=0))):
        here = np.flatnonzero(size > j)
        low = (values[here] >> np.uint64(7 * j)) & np.uint64(127)
        out[ends[here] - size[here] + j] = low.astype(np.uint8) | ((size[here] > j + 1) * np.uint8(128)).astype(np.uint8)
    return out, ends


def unvarints(data: np.ndarray) -> np.ndarray:
    """The numbers that `varints` wrote."""
    last = np.flatnonzero(data < 128)
    if not len(last):
        return np.zeros(0, np.int64)
    first = np.concatenate(([0], last[:-1] + 1))
    place = np.arange(len(data)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((data & 127).astype(np.uint64) << (7 * place).astype(np.uint64), first).astype(np.int64)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices starts[i] .. starts[i] + sizes[i] - 1 of all i in a row."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sums of consecutive stretches, empty ones included."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def packed(*parts: bytes) -> bytes:
    """Some byte strings as one compressed one."""
    sizes = np.array([len(p) for p in parts], "<u8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(bytes([len(parts)]) + sizes + b"".join(parts))


def unpacked(data: bytes) -> list[bytes]:
    """The byte strings that `packed` took."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    at = 1 + 8 * raw[0]
    ends = (at + np.cumsum(np.frombuffer(raw[1:at], "<u8").astype(np.int64))).tolist()
    return [raw[a:b] for a, b in zip([at, *ends], ends)]


def binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive stretches of bytes as a binary column."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def joined_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column in a row, and the size of each value."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8), np.fromiter(map(len, values), np.int64, len(values))


def whole_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block as one table, from batches in which a block's rows follow one another."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        block = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if held and block[a] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = block[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def with_values(rows: DataFrame, values: DataFrame, key: str, hot_rows: int = HOT_ROWS, share: int = SHARE, salts: int = SALTS) -> DataFrame:
    """Block rows with the columns of the one row of `values` (key, rows, ...) that has their key; `rows` says how many block rows have it.

    `values` is a written table that holds every key once. At most `share` hashes of hot keys reach the driver.
    """
    total = values.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    limit = max(hot_rows, total // share)
    mark = F.xxhash64(key)
    hot = [r[0] for r in values.where(F.col("rows") > limit).select(mark).distinct().collect()]
    heavy = mark.isin(hot) if hot else F.lit(False)
    spread = rows.withColumn("__salt", F.when(heavy, F.pmod("block", F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    every = F.when(heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return spread.join(values.drop("rows").withColumn("__salt", F.explode(every)), [key, "__salt"]).drop("__salt")


def in_blocks(frame: DataFrame) -> DataFrame:
    """Rows dealt out and sorted by block, each block whole in one partition, by k inside it."""
    return frame.repartition("block").sortWithinPartitions("block", "k")
