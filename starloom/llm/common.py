"""What the operators share: tables, Python reachability, batches of bounded size, hashing of words and shingles."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Bytes of text that one vectorised step holds; a longer document is a step of its own.
STEP_BYTES = 1 << 18


#: What a worker keeps between tasks and may drop: functions that empty a cache.
CACHES: list[Callable[[], None]] = []


def give_back() -> None:
    """Drop what earlier stages left in this worker and return free memory to the system; called where a stage needs much itself."""
    for clear in CACHES:
        clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its memory
        pass


def lean(run: Callable) -> Callable:
    """A function of a task's batches that leaves its worker small for the stages after it."""

    @wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; an installed package needs nothing."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(divisor)


def steps(texts: Iterable[str | None], limit: int = STEP_BYTES) -> Iterator[list[str]]:
    """Consecutive texts, null as empty, in lists of at most `limit` characters or one text."""
    held: list[str] = []
    size = 0
    for text in texts:
        text = text if isinstance(text, str) else ""
        if held and size + len(text) > limit:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def column_texts(column: pa.Array, rows: int = 256) -> Iterator[str | None]:
    """The texts of an Arrow column; only some rows at a time become strings."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


def frame_steps(batches: Iterable[pd.DataFrame], column: str = "text", limit: int = STEP_BYTES) -> Iterator[tuple[pd.DataFrame, list[str]]]:
    """The rows of Arrow batches in slices whose texts are one step."""
    for batch in batches:
        at = 0
        for held in steps(batch[column], limit):
            yield batch.iloc[at : at + len(held)], held
            at += len(held)


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


# Fixed random constants of the hash functions; any odd numbers would do, but all executors must use the same.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LANES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
_BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser on unsigned 64-bit numbers."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


CACHES.append(_powers.cache_clear)


def _class_table(separators: str) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: does it separate words, and its lower case for A-Z."""
    code = np.arange(256)
    blank = (code == 0x20) | ((code >= 0x09) & (code <= 0x0D))
    if separators == "nonword":
        letter = ((code | 0x20) >= 0x61) & ((code | 0x20) <= 0x7A)
        blank = (code < 0x80) & ~letter & ~((code >= 0x30) & (code <= 0x39))
    lower = np.where((code >= 0x41) & (code <= 0x5A), code + 32, code).astype(np.uint8)
    return blank, lower


_CLASSES = {name: _class_table(name) for name in ("space", "nonword")}


def word_hashes(texts: list[str], separators: str = "space") -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z lower-cased, and the number of words of each text.

    `space`: words are runs without U+0020 and U+0009 to U+000D. `nonword`: ASCII punctuation separates as well.
    """
    blank, lower = _CLASSES[separators]
    raw = [utf8(t) for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = lower[np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)]
    ends_of_text = np.cumsum(sizes + 1)
    gap = blank[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).astype(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    if len(begin) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    up, down = _powers(1 << max(20, int(len(data) + 1).bit_length()))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)], dtype=np.uint64)))
    words = mixed((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
    counts = np.diff(np.searchsorted(begin, np.concatenate(([0], ends_of_text))))
    return words, counts


def shingle_hashes(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within the text, and their number per text.

    A text with fewer words than `width` has one shingle, all its words; one without words has none.
    """
    words, counts = word_hashes(texts)
    starts = np.cumsum(counts) - counts
    n = len(words)
    summed = np.zeros(n, np.uint64)
    for k in range(width):
        summed[: max(n - k, 0)] += words[k:] * _LANES[k]
    have = np.maximum(counts - width + 1, 0)
    text_of = np.repeat(np.arange(len(texts)), have)
    at = np.arange(have.sum()) - np.repeat(np.cumsum(have) - have, have) + np.repeat(starts, have)
    hashes = mixed(summed[at])
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        alone = np.array([sum(int(words[starts[i] + k]) * int(_LANES[k]) for k in range(counts[i])) + int(counts[i]) & (1 << 64) - 1 for i in short], dtype=np.uint64)
        hashes, text_of = np.concatenate((hashes, mixed(alone))), np.concatenate((text_of, short))
    order = np.lexsort((hashes, text_of))
    hashes, text_of = hashes[order], text_of[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (text_of[1:] != text_of[:-1])
    return hashes[first], np.bincount(text_of[first], minlength=len(texts))


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)
