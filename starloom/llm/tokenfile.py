"""Token ids in a compact binary form: canonical length-limited Huffman code, independent blocks, bit-offset checkpoints.

Form. A shard holds the documents of one range of doc_id, in ascending order, as blocks in that order. A block holds whole documents:
their ids (doc_ids, little-endian signed 64 bits, `nulls` marking null ids), their numbers of tokens (counts, unsigned 64 bits), the code
words of their tokens one after another, highest bit first (payload, filled up with zero bits to a byte), and the bit offset of every
STRIDE-th token (checkpoints, unsigned 64 bits). `start` is the number of tokens in all earlier blocks. A block needs nothing but the code
table: the length of each id's code word, 0 to LONGEST; words are canonical, by length and then by id. Blocks are rows of Parquet files, one
folder for each shard, so that Spark's committer keeps a file whole when an executor is lost, and any store Spark reaches will do.

Null text is empty: one end id. Null doc_id comes first. Rows may repeat: each is a document, repeats in any order. An empty table gives
no block. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import frame_steps, reachable, table
from .tokens import encoder, tokenizer_path

LONGEST = 16
STRIDE = 256
#: A block is closed when it has so many tokens; a longer document is a block of its own.
BLOCK_TOKENS = 1 << 18
END_ID = 0


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of an optimal prefix code of at most `longest` bits (package-merge); 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids need more than {longest} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    levels, weights = [], leaves
    for _ in range(longest - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate((leaves, pairs))
        order = np.argsort(merged, kind="stable")
        levels.append(order)
        weights = merged[order]
    take = 2 * len(used) - 2
    for order in reversed(levels):
        chosen = order[:take]
        own = chosen[chosen < len(used)]
        lengths[used[own]] += 1
        take = 2 * (take - len(own))
    lengths[used[:take]] += 1
    return lengths


def code_words(lengths: np.ndarray) -> np.ndarray:
    """Canonical code words: by length, then by id."""
    words = np.zeros(len(lengths), np.uint32)
    word = 0
    for n in range(1, int(lengths.max(initial=0)) + 1):
        word <<= 1
        ids = np.flatnonzero(lengths == n)
        words[ids] = word + np.arange(len(ids), dtype=np.uint32)
        word += len(ids)
    return words


def pack_bits(ids: np.ndarray, words: np.ndarray, lengths: np.ndarray, stride: int = STRIDE) -> tuple[bytes, np.ndarray]:
    """The code words of the ids in a row, and the bit offset of every stride-th."""
    if not len(ids):
        return b"", np.zeros(0, "<u8")
    ids = ids.astype(np.intp)
    sizes, codes = lengths[ids], words[ids]
    parts = np.add.reduceat(sizes, np.arange(0, len(ids), stride), dtype=np.int64)
    if len(ids) % 2:
        sizes, codes = np.append(sizes, np.uint8(0)), np.append(codes, np.uint32(0))
    # Two code words are one of at most 32 bits, so half as many have to be placed.
    codes = codes[0::2] << sizes[1::2] | codes[1::2]
    sizes = (sizes[0::2] + sizes[1::2]).astype(np.int64)
    ends = np.cumsum(sizes)
    at = ends - sizes
    cell = at >> 5
    wide = codes.astype(np.uint64) << (64 - sizes - (at & 31)).astype(np.uint64)
    first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    held = np.add.reduceat(wide, first)  # bits of different words never meet
    cells = np.zeros(int(ends[-1] + 31 >> 5) + 2, np.uint64)
    cells[cell[first]] = held >> np.uint64(32)
    cells[cell[first] + 1] += held & np.uint64(0xFFFFFFFF)
    return cells.astype(">u4").tobytes()[: int(ends[-1] + 7 >> 3)], (np.cumsum(parts) - parts).astype("<u8")


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each prefix of LONGEST bits: the id it begins with and its number of bits."""
    words = code_words(lengths)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    span = 1 << (LONGEST - lengths[used].astype(np.int64))
    begin = words[used].astype(np.int64) << (LONGEST - lengths[used].astype(np.int64))
    ids, bits = np.zeros(1 << LONGEST, np.uint32), np.ones(1 << LONGEST, np.uint8)
    ids[: span.sum()] = np.repeat(used, span)
    bits[: span.sum()] = np.repeat(lengths[used], span)
    assert not len(begin) or (begin == np.cumsum(span) - span).all()
    return ids, bits


def unpack_bits(payload: bytes, checkpoints: np.ndarray, number: int, tables: tuple[np.ndarray, np.ndarray], stride: int = STRIDE) -> np.ndarray:
    """The ids of a block; all stretches between checkpoints advance together, one id in each step."""
    ids, bits = tables
    raw = np.frombuffer(payload + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
    sliding = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
    at = checkpoints.astype(np.int64)
    out = np.zeros((stride, len(at)), np.uint32)
    last = number - (len(at) - 1) * stride if len(at) else 0
    for k in range(stride if len(at) > 1 else last):
        if k == last and len(at) > 1:
            at = at[:-1]
        prefix = sliding[at >> 3] >> (8 - (at & 7)).astype(np.uint32) & np.uint32(0xFFFF)
        out[k, : len(at)] = ids[prefix]
        at = at + bits[prefix]
    return out.T.reshape(-1)[:number]


#: The last row of a task has no document but `counts`: how often each id from 0 on occurs in the task.
_TOKENS = "shard int, seq long, before long, doc_id long, n long, ids binary, counts binary"
_BLOCKS = "shard int, first_seq long, before long, n_docs long, n_tokens long, doc_ids binary, nulls binary, counts binary, payload binary, checkpoints binary"


def _tokenize(path: str, end_id: int, markers: bool):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, before, seen = TaskContext.get().partitionId(), 0, 0, np.zeros(1, np.int64)
        for rows, texts in frame_steps(batches):
            ids = [x + end for x in encoder(path, markers=markers).encode(texts)]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            row = np.frombuffer(b"".join(ids), "<u4")
            seen = _added(seen, np.bincount(row))
            if row.max() < 1 << 16:
                data, ends = row.astype("<u2").tobytes(), (2 * np.cumsum(n)).tolist()
                ids = [data[a:b] for a, b in zip([0, *ends], ends)]
            yield pd.DataFrame({"shard": part, "seq": np.arange(seq, seq + len(n)), "before": before + np.cumsum(n) - n, "doc_id": rows["doc_id"].astype("Int64"), "n": n, "ids": ids, "counts": None})
            seq, before = seq + len(n), before + int(n.sum())
        yield pd.DataFrame({"shard": [part], "seq": [seq], "before": [before], "doc_id": pd.array([None], "Int64"), "n": [0], "ids": [b""], "counts": [seen.astype("<i8").tobytes()]})

    return run


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of counts by id, of which either may end earlier."""
    out = np.zeros(max(len(a), len(b)), np.int64)
    out[: len(a)] = a
    out[: len(b)] += b
    return out


def _ids(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4")


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen = np.zeros(1, np.int64)
    for batch in batches:
        for data in batch["counts"]:
            seen = _added(seen, np.frombuffer(data, "<i8"))
    kept = np.flatnonzero(seen)
    yield pd.DataFrame({"id": kept, "n": seen[kept]})


def _blocks(lengths: np.ndarray):
    words = code_words(lengths)

    def block(held: list[tuple]) -> dict:
        payload, checkpoints = pack_bits(np.concatenate([_ids(r.ids, r.n) for r in held]), words, lengths)
        known = [not pd.isna(r.doc_id) for r in held]
        return {
            "shard": held[0].shard, "first_seq": held[0].seq, "before": held[0].before, "n_docs": len(held), "n_tokens": sum(r.n for r in held),
            "doc_ids": np.array([int(r.doc_id) if k else 0 for r, k in zip(held, known, strict=True)], "<i8").tobytes(),
            "nulls": b"" if all(known) else bytes(not k for k in known), "counts": np.array([r.n for r in held], "<u8").tobytes(),
            "payload": payload, "checkpoints": checkpoints.tobytes(),
        }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for row in batch.astype({"doc_id": "Int64"}).itertuples(index=False):
                if held and (size + row.n > BLOCK_TOKENS or row.shard != held[-1].shard or row.seq != held[-1].seq + 1):
                    yield pd.DataFrame([block(held)])
                    held, size = [], 0
                held.append(row)
                size += row.n
        if held:
            yield pd.DataFrame([block(held)])

    return run


def write_tokens(documents: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, markers: bool = False) -> np.ndarray:
    """Write the ids of all documents below the path; return the code lengths, which are written beside them.

    With markers, special tokens' strings in a text become special ids. Texts are dealt out by doc_id before they are tokenized, so that ids are moved once, as code words.
    """
    spark = documents.sparkSession
    reachable(spark)
    source = tokenizer or tokenizer_path("byte_bpe_50k.json")
    ordered = documents.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    plain = f"{path}/plain"
    ordered.mapInPandas(_tokenize(source, end_id, markers), _TOKENS).write.option("compression", "zstd").parquet(plain)
    written = spark.read.schema(_TOKENS).parquet(plain)
    tokens = written.where("counts is null").drop("counts")
    counted = written.where("counts is not null").select("counts").mapInPandas(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # a row per id of the vocabulary
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"].to_numpy()] = counted["n"].to_numpy()
    lengths = code_lengths(counts)
    blocks = tokens.mapInPandas(_blocks(lengths), _BLOCKS)
    blocks.write.partitionBy("shard").option("compression", "uncompressed").parquet(f"{path}/blocks")
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, bits int").coalesce(1).write.parquet(f"{path}/code")
    return lengths


def read_code(spark: SparkSession, path: str) -> np.ndarray:
    code = spark.read.schema("id long, bits int").parquet(f"{path}/code").toPandas()
    lengths = np.zeros(int(code["id"].max()) + 1 if len(code) else 1, np.uint8)
    lengths[code["id"].to_numpy()] = code["bits"].to_numpy()
    return lengths


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids (array<int>, or with digest their crc32 as little-endian unsigned 32-bit numbers) of every document."""
    reachable(spark)
    lengths = read_code(spark, path)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).toPandas().sort_values("shard")  # a row per shard
    starts = dict(zip(totals["shard"].tolist(), (totals["n"].cumsum() - totals["n"]).tolist(), strict=True))
    shared = spark.sparkContext.broadcast((lengths, starts))
    last = "ids_crc32 long" if digest else "ids array<int>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lengths, starts = shared.value
        tables = decode_table(lengths)
        for batch in batches:
            for b in batch.itertuples(index=False):
                ids = unpack_bits(b.payload, np.frombuffer(b.checkpoints, "<u8"), b.n_tokens, tables).astype("<u4")
                n = np.frombuffer(b.counts, "<u8").astype(np.int64)
                ends = np.cumsum(n)
                parts = [ids[e - k : e] for e, k in zip(ends, n, strict=True)]
                doc_ids = pd.Series(np.frombuffer(b.doc_ids, "<i8")).astype("Int64")
                if b.nulls:
                    doc_ids[np.frombuffer(b.nulls, np.uint8) > 0] = pd.NA
                yield pd.DataFrame({"doc_id": doc_ids, "start": starts[b.shard] + b.before + ends - n, "n_tokens": n, "out": [zlib.crc32(p.tobytes()) for p in parts] if digest else [p.astype(np.int32) for p in parts]}).rename(columns={"out": last.split()[0]})

    return blocks.mapInPandas(run, f"doc_id long, start long, n_tokens long, {last}")


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-file")
    write_tokens(table(spark, sf_dir, "documents"), path, markers=True)
    return read_tokens(spark, path, digest=True)
