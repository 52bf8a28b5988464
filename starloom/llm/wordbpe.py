"""Byte-level BPE by one global shuffle of distinct words.

1. Texts are cut by the splitting pattern; the words of a block of documents are exploded with their positions: each position of the block has the
   number of its word, each distinct word of the block is listed once. A block's words travel packed, one row for each hash bucket of words.
2. The words of all blocks meet by bucket in one shuffle; each distinct word lies in one bucket and is encoded there once, by the ranks. A
   frequent word comes once a block, whatever its occurrences, and buckets are alike in size.
3. The ids go back to the blocks, where they join the positions: a document's ids are those of its words in a row.
4. Decoding joins the table of the tokens' bytes, which is as large as the vocabulary (its size is checked), to the ids.

Words are cut as the encoding library cuts them: characters that the library's Unicode tables class otherwise than the tables used here are
replaced by one of the library's class while the borders are found.

Null text is empty: no ids, no bytes. Rows may repeat and ids may be null: each row is a document by itself. An empty table gives no rows.
Extra columns are ignored. A document longer than a block is a block of its own and must fit a task's memory, about ten times its characters.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, plan_size
from .blocks import BLOCK_CHARS, binaries, in_blocks, packed, ragged, sums, unpacked, unvarints, varints, whole_blocks
from .common import reachable, table
from .tokens import tokenizer_path

#: Most bytes of a vocabulary that is handed to every task.
MOST_VOCABULARY = 64 << 20
_EXPLODED = "block long, k int, words binary, positions binary, doc_ids array<long>, sizes array<int>"
#: Characters of a block. Its distinct words are in memory, the words of its texts aren't.
WORD_BLOCK = 4 * BLOCK_CHARS
#: Hash buckets of words for each 2^30 bytes that the plan expects, and at most in all: a task holds the distinct words of one.
BUCKETS_PER_GB = 16
MOST_BUCKETS = 8192


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a line a token, base64 and a decimal number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def bpe(ranks: dict[bytes, int]):
    """The library's merges by rank; its own splitting isn't used."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def stand_ins() -> dict[int, str]:
    """Characters that the library and this process class differently (letter, number, white space, other), with a character of the library's class."""
    import regex
    import tiktoken

    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, codes))
    single = {bytes([b]): b for b in range(256)}
    ours, theirs = np.zeros(0x110000, np.uint8), np.zeros(0x110000, np.uint8)
    for number, kind in enumerate((r"\p{L}", r"\p{N}", r"\s"), 1):
        ours[[ord(c) for c in regex.findall(kind, every)]] = number
        found = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        theirs[[ord(c) for c in bytes(found).decode()]] = number
    return {int(c): "b0 "[theirs[c]] for c in np.flatnonzero(ours != theirs)}


class Splitter:
    """Cuts texts into the matches of a pattern, as the library does."""

    def __init__(self, pattern: str, instead: dict[int, str]):
        import regex

        self.words = regex.compile(pattern)
        self.instead = instead
        codes = sorted(instead)
        runs = np.split(np.array(codes, np.int64), np.flatnonzero(np.diff(codes) > 1) + 1) if codes else []
        self.strange = regex.compile("[" + "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs) + "]") if codes else None

    def __call__(self, text: str) -> list[str]:
        if self.strange is None or text.isascii() or not self.strange.search(text):
            return self.words.findall(text)
        return [text[m.start() : m.end()] for m in self.words.finditer(text.translate(self.instead))]


@lru_cache(maxsize=4)
def _splitter(pattern: str, instead: tuple) -> Splitter:
    return Splitter(pattern, dict(instead))


def _exploded(split: Callable[[], Callable[[str], list[str]]], block_chars: int, buckets: int):
    names = [c.split()[0] for c in _EXPLODED.split(", ")]

    def closed(block: int, doc_ids: list, sizes: list[int], codes: list[np.ndarray], known: dict[str, int]) -> Iterator[pa.RecordBatch]:
        lists = [pa.array([doc_ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([-1], pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), *lists], names)
        if not known:
            return
        words, code = [w.encode() for w in known], np.concatenate(codes)
        number = np.bincount(code)
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        spelt = np.empty(len(words), np.int64)
        spelt[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((spelt, bucket, -number))  # frequent words get small numbers; among equals, a bucket's words follow each other
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        bucket = bucket[order]
        positions = packed(varints(rank[code])[0].tobytes(), bucket.astype("<u2").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([-2], pa.int32()), pa.nulls(1, pa.binary()), pa.array([positions], pa.binary()), pa.nulls(1, lists[0].type), pa.nulls(1, lists[1].type)], names)
        dealt = np.argsort(bucket, kind="stable")
        first = np.flatnonzero(np.diff(bucket[dealt], prepend=-1))
        rows = []
        for members in np.split(order[dealt], first[1:]):
            own = [words[i] for i in members.tolist()]
            rows.append(packed(_numbers(map(len, own), len(own)), b"".join(own)))
        n = len(rows)
        columns = [pa.array(np.full(n, block)), pa.array(bucket[dealt][first].astype(np.int32)), pa.array(rows, pa.binary())]
        yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.binary()), pa.nulls(n, lists[0].type), pa.nulls(n, lists[1].type)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, part, number = split(), TaskContext.get().partitionId(), 0
        doc_ids, sizes, codes, chars, known = [], [], [], 0, _numbering()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").cast(pa.int64()).to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = cut(text) if text else []
                doc_ids.append(doc_id)
                sizes.append(len(found))
                codes.append(np.fromiter(map(known.__getitem__, found), np.uint32, len(found)))
                chars += len(text or "")
                if chars >= block_chars or len(doc_ids) >= block_chars >> 4:
                    yield from closed((part << 32) + number, doc_ids, sizes, codes, known)
                    number, doc_ids, sizes, codes, chars, known = number + 1, [], [], [], 0, _numbering()
        if doc_ids:
            yield from closed((part << 32) + number, doc_ids, sizes, codes, known)

    return run


def _numbering() -> dict[str, int]:
    """A dictionary that numbers what it is asked for."""
    known: defaultdict[str, int] = defaultdict()
    known.default_factory = known.__len__
    return known


def _numbers(values, n: int) -> bytes:
    return varints(np.fromiter(values, np.int64, n))[0].tobytes()


def _cut(data: bytes, sizes: np.ndarray) -> list[bytes]:
    ends = np.cumsum(sizes).tolist()
    return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def _encoded(ranks: Callable[[], dict[bytes, int]]):
    """Rows sorted by bucket, so that a task knows the words of one bucket at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core, current, known = bpe(ranks())._core_bpe, None, {}
        for batch in batches:
            out = []
            for k, words in zip(batch.column("k").to_pylist(), batch.column("words").to_pylist(), strict=True):
                if k != current:
                    current, known = k, {}
                sizes, data = unpacked(words)
                own = _cut(data, unvarints(np.frombuffer(sizes, np.uint8)))
                for w in own:
                    if w not in known:
                        known[w] = np.array(core.encode_single_piece(w), "<u4").tobytes()
                ids = [known[w] for w in own]
                flat = np.frombuffer(b"".join(ids), "<u4")
                out.append(packed(_numbers((len(i) >> 2 for i in ids), len(ids)), flat.astype("<u2" if flat.max() < 1 << 16 else "<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("k"), pa.array(out, pa.binary())], ["block", "k", "ids"])

    return run


class TokenBytes:
    """The bytes of every token, in a row."""

    def __init__(self, ranks: dict[bytes, int]):
        self.sizes = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)
        if self.data.nbytes + self.sizes.nbytes * 2 > MOST_VOCABULARY:
            raise ValueError(f"a vocabulary of {self.data.nbytes} bytes is too large for every task")
        self.decimal = np.array([f"{i} " for i in range(len(self.sizes))], dtype="S")

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.starts[ids], self.sizes[ids])]


def _placed(block: pa.Table) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, numbers of tokens and all ids of a block, from its rows by k: the words of its positions (-2), its documents (-1), ids by bucket."""
    own = block.filter(pc.is_valid(block["doc_ids"]))
    doc_ids, words = own["doc_ids"][0].as_py(), np.array(own["sizes"][0].as_py(), np.int64)
    ids = [unpacked(x) for x in block["ids"].drop_null().to_pylist()]
    code = np.zeros(0, np.int64)
    if ids:
        numbers, bucket = unpacked(block["positions"].drop_null()[0].as_py())
        place = np.empty(len(bucket) // 2, np.int64)
        place[np.argsort(np.frombuffer(bucket, "<u2"), kind="stable")] = np.arange(len(place))
        code = place[unvarints(np.frombuffer(numbers, np.uint8))]
    parts = [unvarints(np.frombuffer(x[0], np.uint8)) for x in ids]
    flat = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(x[1], "<u2" if len(x[1]) == 2 * n.sum() else "<u4") for x, n in zip(ids, parts, strict=True))]).astype(np.int64)
    sizes = np.concatenate([np.zeros(0, np.int64), *parts])
    return doc_ids, sums(sizes[code], words), flat[ragged((np.cumsum(sizes) - sizes)[code], sizes[code])]


def _assembled(ranks: Callable[[], dict[bytes, int]], digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenBytes(ranks())
        for block in whole_blocks(batches):
            doc_ids, numbers, ids = _placed(block)
            text = known.decode(ids)
            sizes = sums(known.sizes[ids], numbers)
            ends, cuts = np.cumsum(numbers), np.cumsum(sizes)
            if digests:
                said = [hashlib.sha256(known.decimal[ids[e - n : e]].tobytes().replace(b"\0", b"")[:-1]).hexdigest() for e, n in zip(ends, numbers, strict=True)]
                read = [hashlib.sha256(text[e - n : e]).hexdigest() for e, n in zip(cuts, sizes, strict=True)]
                columns = {"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(numbers), "ids_sha256": said, "decoded_sha256": read}
            else:
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids.astype(np.int32)))
                columns = {"doc_id": pa.array(doc_ids, pa.int64()), "ids": lists, "decoded": binaries(text, cuts)}
            yield from pa.table(columns).to_batches()

    return run


def encode_and_decode(documents: DataFrame, ranks: str | None = None, pattern: str | None = None, digests: bool = False, block_chars: int = WORD_BLOCK, buckets: int | None = None) -> DataFrame:
    """doc_id and, per document, ids (array<int>) and decoded (binary), or with digests n_tokens, ids_sha256 and decoded_sha256.

    ranks: a rank file; pattern: what a word is; buckets: hash buckets of words, by the plan's size if not given. Neither buckets nor blocks change the result.
    """
    spark = documents.sparkSession
    reachable(spark)
    path = ranks or tokenizer_path("byte_bpe_50k.tiktoken")
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    instead = tuple(sorted(stand_ins().items()))
    if buckets is None:
        buckets = min(BUCKETS_PER_GB * (1 + (plan_size(documents.select("text")) >> 30)), MOST_BUCKETS)
    texts = documents.select("doc_id", "text")
    exploded = materialize(texts.mapInArrow(_exploded(lambda: _splitter(pattern, instead), block_chars, buckets), _EXPLODED), "exploded")
    words = exploded.where("k >= 0").select("block", "k", "words").repartition("k").sortWithinPartitions("k")
    ids = words.mapInArrow(_encoded(lambda: read_ranks(path)), "block long, k int, ids binary")
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (("positions", "binary"), ("doc_ids", "array<long>"), ("sizes", "array<int>"), ("ids", "binary"))}
    rows = exploded.select("block", "k", "positions", "doc_ids", "sizes", none["ids"]).unionByName(ids.select("block", "k", none["positions"], none["doc_ids"], none["sizes"], "ids"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "doc_id long, ids array<int>, decoded binary"
    return in_blocks(rows).mapInArrow(_assembled(lambda: read_ranks(path), digests), schema)


def decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id and decoded (binary) of rows with ids (array<int>); null ids are none."""
    reachable(encoded.sparkSession)
    path = ranks or tokenizer_path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenBytes(read_ranks(path))
        for batch in batches:
            ids = [np.array(x or [], np.int64) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([known.decode(x).tobytes() for x in ids], pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(table(spark, sf_dir, "documents"), digests=True)
