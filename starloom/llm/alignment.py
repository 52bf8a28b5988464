"""Cross-tokenizer alignment: divide and conquer at shared cuts.

A text is encoded by two tokenizers; a byte offset at which tokens of both end is a shared cut. An interval between two shared cuts is divided
at the shared cut nearest to its middle: the end of a middle token of A is looked up among B's by bisection, then those of its neighbours to
either side. Both halves are divided in the same way; an interval without an inner cut is a group. All open intervals of a step of documents
are divided together, one level of the recursion at a time.

Links are the pairs of an A and a B token whose bytes overlap. How many documents hold a pair of ids linked is counted over the corpus: blocks
of documents list their distinct pairs, the counts are summed and come back to the blocks by pair.

A is a byte-level BPE given as a vocabulary file whose merges are in the order of their ids (that is checked), B a sentencepiece model. Texts
that are null or empty, or that either tokenizer doesn't give back byte for byte (behind one space), have no tokens: zeros, an empty digest.
Rows may repeat and ids may be null: each row is a document. An empty table gives no rows. Extra columns are ignored. A document longer
than a block is a block of its own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .blocks import BLOCK_CHARS, binaries, in_blocks, joined_bytes, ragged, sums, unvarints, varints, whole_blocks, with_values
from .common import reachable, steps, table, utf8
from .tokens import tokenizer_path

_DOC = "doc_id:long,n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string,pairs:long"
_LISTED = f"block long, k int, pair long, docs long, own array<struct<{_DOC}>>, codes binary, times binary"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
#: Neighbours to try for all open intervals in a row, before the rest of an interval is looked up at once.
PROBES = 4


def byte_of_char() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary: printable Latin-1 as itself, the others from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class Side:
    """The bytes and the decimal numbers of a tokenizer's ids."""

    def __init__(self, tokens: dict[int, bytes]):
        every = [tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)]
        self.sizes = np.array([len(t) for t in every], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(every), np.uint8)
        # "12," and the like in eight bytes, filled up with zero bytes
        self.decimal = {c: np.array([f"{i}{c}" for i in range(len(every))], "S8").view(np.uint64) for c in ",|;"}

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.starts[ids], self.sizes[ids])]


class ByteLevel(Side):
    """A: the byte-level BPE of a vocabulary file, each text behind a space; special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as text:
            model = json.load(text)["model"]
        special = set(self._special(path))
        as_byte = byte_of_char()
        tokens = {i: bytes(as_byte[c] for c in t) for t, i in model["vocab"].items() if i not in special}
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if any(a >= b for a, b in zip(made, made[1:])):
            raise ValueError(f"{path}: merges are not in the order of their ids")
        super().__init__(tokens)
        self.library = tiktoken.Encoding("A", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in tokens.items()}, special_tokens={})

    @staticmethod
    def _special(path: str) -> list[int]:
        from tokenizers import Tokenizer

        return [i for i, t in Tokenizer.from_file(path).get_added_tokens_decoder().items() if t.special]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.library.encode_ordinary(" " + t) for t in texts]


class Pieces(Side):
    """B: a sentencepiece model, which puts a space before the text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        tokens = {}
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            tokens[i] = bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else utf8(piece.replace("▁", " "))
        super().__init__(tokens)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def tokenizers(a: str, b: str) -> tuple[Side, Side]:
    return ByteLevel(a), Pieces(b)


def cut(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, last_a: np.ndarray, first_b: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First tokens of A and of B of all groups, in order.

    ends_a and ends_b ascend over all documents; interval i holds A's tokens first_a[i] .. last_a[i] - 1 and B's likewise, and ends at a shared cut.
    """
    low, high, below, above = first_a, last_a, first_b, last_b
    token_b = np.full(int(max(ends_a[-1], ends_b[-1])) + 1 if len(low) else 0, -1, np.int32)  # the first token of B that ends at an offset
    token_b[ends_b[::-1]] = np.arange(len(ends_b) - 1, -1, -1, dtype=np.int32)
    found_a, found_b = [], []
    while len(low):
        middle = (low + high - 1) // 2
        at, partner = np.full(len(low), -1), np.zeros(len(low), np.int64)
        waiting = np.flatnonzero((high - low > 1) & (above - below > 1))
        for offset in [0, *(s * d for d in range(1, PROBES) for s in (1, -1))]:
            tried = middle[waiting] + offset
            inside = (tried >= low[waiting]) & (tried < high[waiting] - 1)
            end = ends_a[np.clip(tried, 0, len(ends_a) - 1)]
            place = token_b[end]
            hit = inside & (place >= 0)
            at[waiting[hit]], partner[waiting[hit]] = tried[hit], place[hit]
            waiting = waiting[~hit]
            if not len(waiting):
                break
        waiting = waiting[high[waiting] - low[waiting] > 2 * PROBES - 1]
        if len(waiting):  # all other ends of the interval at once; the one nearest to the middle counts
            sizes = high[waiting] - 1 - low[waiting]
            tried, owner = ragged(low[waiting], sizes), np.repeat(np.arange(len(waiting)), sizes)
            place = token_b[ends_a[tried]]
            hit = place >= 0
            tried, owner, place = tried[hit], owner[hit], place[hit]
            order = np.lexsort((np.abs(tried - middle[waiting[owner]]), owner))
            tried, owner, place = tried[order], owner[order], place[order]
            head = np.flatnonzero(np.diff(owner, prepend=-1))
            at[waiting[owner[head]]], partner[waiting[owner[head]]] = tried[head], place[head]
        whole = at < 0
        found_a.append(low[whole])
        found_b.append(below[whole])
        parted = ~whole
        at, partner = at[parted] + 1, partner[parted] + 1
        low, high, below, above = low[parted], high[parted], below[parted], above[parted]
        low, high = np.concatenate((low, at)), np.concatenate((at, high))
        below, above = np.concatenate((below, partner)), np.concatenate((partner, above))
    group_a, group_b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (found_a, found_b))
    order = np.argsort(group_a, kind="stable")
    return group_a[order], group_b[order]


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and the B token of every link, by offset: each stretch between neighbouring ends of either kind is one link."""
    if not len(ends_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    here_a, here_b = (np.bincount(ends, minlength=int(max(ends_a[-1], ends_b[-1])) + 1) for ends in (ends_a, ends_b))
    ends = np.flatnonzero(here_a + here_b)
    return (np.cumsum(here_a) - here_a)[ends], (np.cumsum(here_b) - here_b)[ends]


class Aligned:
    """The documents of a step: rows in order; tokens, groups and links of those that have any."""

    def __init__(self, texts: list[str], a: Side, b: Side):
        full = [i for i, t in enumerate(texts) if t]
        pairs = []
        if full:
            whole = [texts[i] for i in full]
            for i, text, x, y in zip(full, whole, a.encode(whole), b.encode(whole), strict=True):
                x, y = np.array(x, np.int64), np.array(y, np.int64)
                raw = utf8(" " + text)
                if a.sizes[x].sum() == b.sizes[y].sum() == len(raw) and a.bytes_of(x).tobytes() == raw == b.bytes_of(y).tobytes():
                    pairs.append((i, x, y, len(raw)))
        self.docs = np.array([p[0] for p in pairs], np.int64)
        self.n_a, self.n_b = (np.array([len(p[k]) for p in pairs], np.int64) for k in (1, 2))
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *(p[k] for p in pairs)]) for k in (1, 2))
        ends_a, ends_b = np.cumsum(a.sizes[self.a]), np.cumsum(b.sizes[self.b])
        last_a, last_b = np.cumsum(self.n_a), np.cumsum(self.n_b)
        self.group_a, self.group_b = cut(ends_a, ends_b, last_a - self.n_a, last_a, last_b - self.n_b, last_b)
        self.n_groups = np.diff(np.searchsorted(self.group_a, np.concatenate(([0], last_a))))
        link_a, link_b = links(ends_a, ends_b)
        self.pairs = self.a[link_a] << 32 | self.b[link_b]
        self.n_links = np.diff(np.searchsorted(link_a, np.concatenate(([0], last_a))))
        self.sides = a, b

    def digests(self) -> list[str]:
        """Of each document, the groups as `a1,a2|b1;a3|b2,b3` in lower-case hex."""
        a, b = self.sides
        n_a = np.diff(np.append(self.group_a, len(self.a)))
        n_b = np.diff(np.append(self.group_b, len(self.b)))
        said = np.zeros(len(self.a) + len(self.b), np.uint64)
        place_a = np.arange(len(self.a)) + np.repeat(self.group_b, n_a)
        place_b = np.arange(len(self.b)) + np.repeat(self.group_a + n_a, n_b)
        said[place_a], said[place_b] = a.decimal[","][self.a], b.decimal[","][self.b]
        end_a, end_b = self.group_a + n_a - 1, self.group_b + n_b - 1
        said[place_a[end_a]], said[place_b[end_b]] = a.decimal["|"][self.a[end_a]], b.decimal[";"][self.b[end_b]]
        ends = np.cumsum(self.n_a + self.n_b)
        return [hashlib.sha256(said[e - n : e].tobytes().translate(None, b"\0")[:-1]).hexdigest() for e, n in zip(ends, self.n_a + self.n_b, strict=True)]


def _listed(a: str, b: str, block_chars: int):
    names = [c.split()[0] for c in _LISTED.split(", ")]
    own_type = pa.list_(pa.struct([(f.split(":")[0], pa.string() if f.endswith("string") else pa.int64()) for f in _DOC.split(",")]))

    def closed(block: int, docs: list[dict], keys: list[np.ndarray], number: list[int]) -> Iterator[pa.RecordBatch]:
        pairs, code = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_inverse=True)
        entry, times = np.unique(np.repeat(np.arange(len(number)), number) * max(len(pairs), 1) + code, return_counts=True)
        doc, code = np.divmod(entry, max(len(pairs), 1))
        held = np.bincount(doc, minlength=len(number))
        gaps = np.diff(code, prepend=0)
        first = (np.cumsum(held) - held)[held > 0]
        gaps[first] = code[first]
        docs = [d | {"pairs": int(n)} for d, n in zip(docs, held, strict=True)]
        packed = [pa.array([varints(x)[0].tobytes()], pa.binary()) for x in (gaps, times)]
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([-1], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([docs], own_type), *packed], names)
        n = len(pairs)
        if n:
            columns = [pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), pa.array(pairs), pa.array(np.bincount(code, minlength=n))]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, own_type), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, part, block = tokenizers(a, b), TaskContext.get().partitionId(), 0
        docs, keys, number, chars = [], [], [], 0
        for batch in batches:
            ids, at = batch.column("doc_id").cast(pa.int64()).to_pylist(), 0
            for texts in steps(batch.column("text").to_pylist()):
                step = Aligned(texts, *sides)
                rows = [{"doc_id": i, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""} for i in ids[at : at + len(texts)]]
                n_links = np.zeros(len(texts), np.int64)
                n_links[step.docs] = step.n_links
                for i, *own in zip(step.docs.tolist(), step.n_a.tolist(), step.n_b.tolist(), step.n_groups.tolist(), step.n_links.tolist(), step.digests(), strict=True):
                    rows[i] |= dict(zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256"), own, strict=True))
                docs += rows
                keys.append(step.pairs)
                number += n_links.tolist()
                at += len(texts)
                chars += sum(map(len, texts))
                if chars >= block_chars or len(docs) >= block_chars >> 4:
                    yield from closed((part << 32) + block, docs, keys, number)
                    block, docs, keys, number, chars = block + 1, [], [], [], 0
        if docs:
            yield from closed((part << 32) + block, docs, keys, number)

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in whole_blocks(batches):
        own = block.filter(pc.is_valid(block["own"]))
        docs = own["own"].combine_chunks().flatten()
        values = block.filter(pc.is_valid(block["n"]))
        n, best = values["n"].to_numpy(), values["best"].to_numpy()
        held = docs.field("pairs").to_numpy()
        gaps, times = (unvarints(joined_bytes(own[c])[0]) for c in ("codes", "times"))
        code = np.cumsum(gaps)
        first = np.cumsum(held) - held
        code -= np.repeat(np.concatenate(([0], code))[first], held)
        out = {c: docs.field(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        out |= {"n_best": pa.array(sums(times * best[code], held)), "count_sum": pa.array(sums(times * n[code], held)), "groups_sha256": docs.field("groups_sha256")}
        yield from pa.table(out).to_batches()


def align(documents: DataFrame, a: str | None = None, b: str | None = None, block_chars: int = BLOCK_CHARS, hot_rows: int | None = None) -> DataFrame:
    """A row of ALIGNED for every row of documents. hot_rows: block rows of a pair of ids from which it may be spread over salts."""
    reachable(documents.sparkSession)
    a, b = a or tokenizer_path("byte_bpe_50k.json"), b or tokenizer_path("piece_bpe_32k.model")
    listed = materialize(documents.select("doc_id", "text").mapInArrow(_listed(a, b, block_chars), _LISTED), "listed")
    used = listed.where("k >= 0").select("block", "k", "pair", "docs")
    counts = materialize(used.groupBy("pair").agg(F.sum("docs").alias("n"), F.count(F.lit(1)).alias("rows")), "pair-counts")
    left = F.shiftright("pair", 32).alias("a")
    highest = counts.groupBy(left).agg(F.max("n").alias("most"))  # an id of A has at most as many pairs as B has ids
    valued = counts.withColumn("a", F.shiftright("pair", 32)).join(highest, "a").select("pair", "rows", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    valued = materialize(valued, "pair-values")
    back = with_values(used.select("block", "k", "pair"), valued, "pair", **({} if hot_rows is None else {"hot_rows": hot_rows, "share": 1 << 40}))
    own = listed.where("k < 0").select("block", "k", "own", "codes", "times", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("best"))
    none = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("own", "codes", "times")]
    return in_blocks(own.unionByName(back.select("block", "k", *none, "n", "best"))).mapInArrow(_counted, ALIGNED)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
