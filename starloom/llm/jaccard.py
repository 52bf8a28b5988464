"""Similarity join of documents on word shingles: Jaccard similarity at or above a threshold, by prefix filtering.

1. One pass hashes each document's set of shingles, names its class (documents with equal sets) by size and a 64-bit digest of the set, and
   counts shingles in a sketch of fixed size. The sketch gives every shingle a rank of rarity; it decides which order is used, never what is
   found, because any order that all documents share is correct.
2. In that order, rarest first, the first n - ceil(t n) + 1 shingles of a class are its prefix: two classes that reach t share one of them.
   Prefix shingles meet in one exchange; those held by one class only are dropped in a pass over the sorted lists, and a list of two classes,
   as most are, becomes a pair at once. The sketch also tells which shingles may be in very many texts: their lists are dealt over salts and
   kept whole.
3. Every class that shares a prefix shingle is first compared with a few classes of that shingle's list, the same for all lists of a group
   (pivots), so that a group of many near copies grows together by its size and not by its square. Then all pairs in a list that are still in
   different components and pass the length and positional filters follow. The suffix filter stands in the join itself: a parity bit for each
   of 512 classes of hashes; the bits in which two sets differ are a lower bound of the elements that only one of them has.
4. Pairs are made distinct and each is verified once, on whole sets. Sets are larger than their texts, so they are never kept: the texts of the
   classes that have a pair are hashed again and their sets go through one exchange, for either end of a pair. Components of the verified links are complete: a pair that was never verified is either in one
   component already or was ruled out by a bound. That is all that components need; similarity_join() by itself goes on and verifies the pairs
   inside components too, so that its links are all pairs of classes that reach the threshold. Their number may grow with the square of a group.

Words are runs without U+0020 and U+0009-U+000D, A-Z in lower case. Fewer words than a shingle: all of them as one. Null or empty text, or
text without words: the empty set, linked with nothing. Rows may repeat: equal texts are one class, whatever their ids. A null id counts as
larger than any other; a component of null ids has a null id. The rows are read several times, so they should be a table, not a computed
frame. Extra columns are ignored by components() and kept by keep_one(). Sets are compared by 64-bit hashes of shingles: two shingles of a
pair of documents are confused with a chance of about n^2 / 2^64.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import TEXT_ROWS, materialize
from .common import column_texts, lean, mixed, reachable, shingle_hashes, signed, steps, table
from .components import connected_components

WIDTH = 5
#: Least similarity, in hundredths.
PERCENT = 75
#: Counters of the rarity sketch, one byte each when broadcast; fixed, whatever the input.
SKETCH = 1 << 22
_SKETCH_PARTS = 64
#: Bits of the bitmaps that spare rows a shuffle; fixed. A full bitmap spares nothing and loses nothing.
BITS = 1 << 24
#: Stands for a null id where rows that lend their sets are named.
NO_ID = -(1 << 63)
_SALTS = (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D)
PIVOT_ROUNDS = 2
#: Numbers of 64 parity bits for each set.
SIGNATURE = 8
_MARKS = [f"s{k}" for k in range(SIGNATURE)]


def class_keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each set; 0 for the empty one."""
    ends = np.cumsum(counts)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(hashes ^ np.uint64(_SALTS[0])), dtype=np.uint64)))
    keys = mixed(total[ends] - total[ends - counts] + counts.astype(np.uint64))
    return signed(np.where(counts > 0, keys, np.uint64(0)))


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each set, whether an odd number of its hashes falls into each of 64 * SIGNATURE classes, as SIGNATURE signed 64-bit numbers.

    The classes are leading bits of the hashes, which are sorted within a set, so each number is one run of them.
    """
    out = np.zeros(len(counts) * SIGNATURE, np.uint64)
    if len(hashes):
        cell = (hashes >> np.uint64(65 - (64 * SIGNATURE).bit_length())).astype(np.int64)
        slot = np.repeat(np.arange(len(counts)), counts) * SIGNATURE + (cell >> 6)
        starts = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        out[slot[starts]] = np.bitwise_xor.reduceat(np.uint64(1) << (cell & 63).astype(np.uint64), starts)
    return signed(out).reshape(len(counts), SIGNATURE)


def may_reach(percent: int) -> str:
    """The suffix filter of two sets of n_a and n_b elements with the marks a0.. and b0..: no more bits differ than elements may."""
    differing = " + ".join(f"bit_count(a{k} ^ b{k})" for k in range(SIGNATURE))
    least_common = f"({percent} * (n_a + n_b) + {99 + percent}) div {100 + percent}"
    return f"{differing} <= n_a + n_b - 2 * ({least_common})"


def _hashed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Step by step: the ids, the shingles of all texts in a row, their number and the class of each text."""
    for batch in batches:
        ids, at = batch.column("doc_id").cast(pa.int64()), 0
        for texts in steps(column_texts(batch.column("text"))):
            hashes, counts = shingle_hashes(texts, width)
            yield ids.slice(at, len(texts)), hashes, counts, class_keys(hashes, counts)
            at += len(texts)


def _first_of(keys: Iterable, counts: np.ndarray, seen: set) -> np.ndarray:
    """Which texts with shingles have a key that this task has not met before; copies need no second set."""
    first = np.zeros(len(counts), bool)
    for i, k in enumerate(keys):
        first[i] = counts[i] > 0 and k not in seen
        seen.add(k)
    return first


def _keyed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = np.zeros(SKETCH, np.uint32), set()
        names = ["doc_id", "n", "ck", *_MARKS, "lends", "part", "counts"]
        for ids, hashes, counts, keys in _hashed(batches, width):
            size = len(ids)
            cell = (hashes >> np.uint64(42)).astype(np.int64)
            if len(hashes) > SKETCH // 8:
                sketch += np.bincount(cell, minlength=SKETCH).astype(np.uint32)
            else:
                np.add.at(sketch, cell, 1)
            marks, lends = signatures(hashes, counts), _first_of(keys.tolist(), counts, seen)
            columns = [ids, pa.array(counts, pa.int64()), pa.array(keys), *[pa.array(marks[:, k].copy()) for k in range(SIGNATURE)], pa.array(lends)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(size, -1, np.int32)), pa.nulls(size, pa.binary())], names)
        parts = [(k, zlib.compress(p.astype("<u4").tobytes(), 1)) for k, p in enumerate(np.split(sketch, _SKETCH_PARTS)) if p.any()]
        none = [pa.nulls(len(parts), pa.int64())] * (3 + SIGNATURE)
        yield pa.RecordBatch.from_arrays([*none, pa.nulls(len(parts), pa.bool_()), pa.array([k for k, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())], names)

    return run


_KEYED = "doc_id long, n long, ck long, " + ", ".join(f"{s} long" for s in _MARKS) + ", lends boolean, part int, counts binary"


def _wanted_sets(width: int, shared):
    """The sets of the rows whose id and class two bitmaps may hold, one of each class and id in a task; texts of other ids are not hashed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()

        def likely() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy()
                yield batch.filter(pa.array(in_bitmap(shared.value[0], ids)))

        for ids, hashes, counts, keys in _hashed(likely(), width):
            rows = ids.fill_null(NO_ID).to_numpy()
            first = _first_of(zip(keys.tolist(), rows.tolist(), strict=True), counts, seen) & in_bitmap(shared.value[1], keys)
            ends = np.concatenate(([0], np.cumsum(counts[first]))).astype(np.int32)
            items = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(hashes[np.repeat(first, counts)])))
            yield pa.RecordBatch.from_arrays([pa.array(keys[first]), pa.array(rows[first]), items], ["ck", "lender", "items"])

    return run


def _sketch_levels(keyed: DataFrame) -> np.ndarray:
    """The merged sketch on a logarithmic scale of one byte; SKETCH bytes reach the driver."""
    size = SKETCH // _SKETCH_PARTS

    def half(rows: pd.DataFrame) -> np.ndarray:
        total = np.zeros(size, np.uint64)
        for c in rows["counts"]:
            raw = zlib.decompress(c)
            total += np.frombuffer(raw, "<u4" if len(raw) == 4 * size else "<u8").astype(np.uint64)
        return total

    def some(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [int(key[0])], "counts": [zlib.compress(half(rows).astype("<u8").tobytes(), 1)]})

    def all_(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [int(key[0])], "counts": [np.minimum(np.log2(half(rows) + 1.0) * 6, 255).astype(np.uint8).tobytes()]})

    parts = keyed.where("part >= 0").select("part", "counts")
    # Two levels, so that no task holds the counters of a part from more than a sixteenth of all partitions.
    summed = parts.groupBy("part", F.pmod(F.xxhash64("counts"), F.lit(16)).alias("sixteenth")).applyInPandas(some, "part int, counts binary")
    levels = np.zeros((_SKETCH_PARTS, size), np.uint8)
    for part, counts in summed.groupBy("part").applyInPandas(all_, "part int, counts binary").toPandas().itertuples(index=False):
        levels[part] = np.frombuffer(counts, np.uint8)
    return levels.reshape(-1)


def prefix_lengths(counts: np.ndarray, percent: int) -> np.ndarray:
    return np.where(counts > 0, counts + (-percent * counts // 100) + 1, 0)  # n - ceil(t n) + 1


#: Level of the sketch (six for each doubling) from which a shingle's list is dealt over SALTS: about a million texts.
HOT_LEVEL = 120
SALTS = 64


def _prefixes(width: int, percent: int, shared, hot_level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, seen = shared.value, set()
        for _, hashes, counts, keys in _hashed(batches, width):
            first = _first_of(keys.tolist(), counts, seen)
            hashes, counts, keys = hashes[np.repeat(first, counts)], counts[first], keys[first]
            owner = np.repeat(np.arange(len(counts)), counts)
            order = np.lexsort((hashes, levels[(hashes >> np.uint64(42)).astype(np.int64)], owner))
            at = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
            inside = at < np.repeat(prefix_lengths(counts, percent), counts)
            owner, token = owner[inside], hashes[order[inside]]
            hot = levels[(token >> np.uint64(42)).astype(np.int64)] >= hot_level
            salt = np.where(hot, 1 + keys[owner] % SALTS, 0).astype(np.int32)
            columns = [signed(token), keys[owner], counts[owner].astype(np.int32), at[inside].astype(np.int32), salt]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "ck", "n", "pos", "salt"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token, salt and class: each class once, without the lists of one class; salted lists are kept whatever they hold."""
    names = ["token", "ck", "n", "pos", "salt"]
    held, given = None, False  # the last row so far, and whether it has been given out
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in names]
        if held is not None:
            columns = [np.concatenate((h, c)) for h, c in zip(held, columns, strict=True)]
        token, ck, *_, salt = columns
        if not len(token):
            continue
        begins = np.concatenate(([True], (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])))
        fresh = begins | np.concatenate(([True], ck[1:] != ck[:-1]))
        columns = [c[fresh] for c in columns]
        start = np.flatnonzero(begins[fresh])
        size = np.diff(np.append(start, len(columns[0])))
        several = (size > 1) | (columns[4][start] > 0)
        several[0] |= given
        out = np.repeat(several, size)
        last = bool(out[-1])
        held, first = [c[-1:] for c in columns], given
        if first:
            out[0] = False
        given = last
        yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in columns], names)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shared lists; one of two classes is a single row that names the `other`, which is null in the rows of longer and of salted lists.

    A list cut by the end of a batch is held back while it is short; a longer one is given out as it comes.
    """
    names = ["token", "ck", "n", "pos", "salt"]

    def given(columns: list[np.ndarray], start: np.ndarray, couple: np.ndarray) -> pa.RecordBatch:
        heads = start[couple]
        other = np.zeros(len(columns[0]), np.int64)
        other[heads] = columns[1][heads + 1]
        alone, second = np.ones(len(other), bool), np.zeros(len(other), bool)
        alone[heads], second[heads + 1] = False, True
        keep = ~second
        return pa.RecordBatch.from_arrays([*(pa.array(c[keep]) for c in columns[:4]), pa.array(other[keep], mask=alone[keep])], [*names[:4], "other"])

    held, cut = None, False  # rows of the last list; whether rows of it were given out already
    for batch in _shared(batches):
        columns = [batch.column(c).to_numpy() for c in names]
        if held is not None:
            columns = [np.concatenate((h, c)) for h, c in zip(held, columns, strict=True)]
        token, *_, salt = columns
        if not len(token):
            continue
        start = np.flatnonzero(np.concatenate(([True], (token[1:] != token[:-1]) | (salt[1:] != salt[:-1]))))
        size = np.diff(np.append(start, len(token)))
        couple = (size == 2) & (salt[start] == 0)
        couple[0] &= not cut
        if size[-1] <= 2 and not (cut and len(start) == 1):
            held, end, cut = [c[start[-1] :] for c in columns], start[-1], False
            start, couple = start[:-1], couple[:-1]
        else:
            held, end, cut = None, len(token), True
            couple[-1] = False
        yield given([c[:end] for c in columns], start, couple)
    if held is not None:
        yield given(held, np.zeros(1, np.int64), np.array([len(held[0]) == 2 and not held[4][0]]))


def _bit(a: np.ndarray) -> np.ndarray:
    return (mixed(a.astype(np.int64).view(np.uint64)) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)


def bitmap(keys: DataFrame) -> np.ndarray:
    """A bitmap over hashes of one long column; at most BITS / 64 numbers reach the driver."""
    name = keys.columns[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(BITS // 64, np.uint64)
        for batch in batches:
            bit = _bit(batch[name].to_numpy())
            np.bitwise_or.at(own, bit >> 6, np.uint64(1) << (bit & 63).astype(np.uint64))
        kept = np.flatnonzero(own)
        yield pd.DataFrame({"word": kept, "bits": own[kept].view(np.int64)})

    out = np.zeros(BITS // 64, np.uint64)
    found = keys.mapInPandas(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = _bit(keys)
    return (bits[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


@dataclass
class Join:
    """keyed: a row per document (doc_id, n, ck). classes: a row per class (ck, n, rep, size, s0..). links: pairs of classes that reach the threshold (a, b),
    all of them or enough to span the components. roots: (ck, root)."""

    keyed: DataFrame
    classes: DataFrame
    links: DataFrame
    roots: DataFrame


def similarity_join(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT, hot_level: int = HOT_LEVEL, spanning: bool = False) -> Join:
    """With `spanning`, classes that are in one component already are not compared any further."""
    spark = documents.sparkSession
    reachable(spark)
    texts = documents.select("doc_id", "text")
    keyed_all = materialize(texts.mapInArrow(lean(_keyed(width)), _KEYED), "keyed", TEXT_ROWS)
    levels = spark.sparkContext.broadcast(_sketch_levels(keyed_all))
    keyed = keyed_all.where("part = -1")
    marks = [F.max(s).alias(s) for s in _MARKS]
    # The row that lends its class the set, among the first of a task: the smallest id; a null id counts as the smallest number.
    lender = F.min(F.when(F.col("lends"), F.coalesce("doc_id", F.lit(NO_ID)))).alias("lender")
    classes = materialize(keyed.where("n > 0").groupBy("ck", "n").agg(F.min("doc_id").alias("rep"), lender, F.count(F.lit(1)).alias("size"), *marks), "classes")

    postings = texts.mapInArrow(lean(_prefixes(width, percent, levels, hot_level)), "token long, ck long, n int, pos int, salt int")
    dealt = postings.repartition("token", "salt").sortWithinPartitions("token", "salt", "ck")
    listed = materialize(dealt.mapInArrow(_lists, "token long, ck long, n int, pos int, other long"), "lists", 4 * TEXT_ROWS)
    couples = listed.where(F.col("other").isNotNull()).select(F.least("ck", "other").alias("a"), F.greatest("ck", "other").alias("b"))
    lists = listed.where(F.col("other").isNull()).drop("other")

    sides = [classes.select(F.col("ck").alias(x), F.col("n").alias(f"n_{x}"), F.col("lender").alias(f"lender_{x}"), *[F.col(s).alias(f"{x}{k}") for k, s in enumerate(_MARKS)]) for x in "ab"]

    length = f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The links among distinct pairs (a, b): length and suffix filters, then whole sets."""
        filtered = pairs.join(sides[0], "a").join(sides[1], "b").where(f"{length} and {may_reach(percent)}")
        filtered = materialize(filtered.select("a", "b", "n_a", "n_b", "lender_a", "lender_b"), name)
        ends = filtered.select(F.col("a").alias("ck"), F.col("lender_a").alias("lender")).unionByName(filtered.select(F.col("b").alias("ck"), F.col("lender_b").alias("lender")))
        wanted = spark.sparkContext.broadcast((bitmap(ends.select("lender")), bitmap(ends.select("ck"))))
        likely = texts.mapInArrow(lean(_wanted_sets(width, wanted)), "ck long, lender long, items array<long>")
        own = likely.repartition("ck", "lender")  # one exchange for both ends; the joins leave out what only the bitmaps let through
        x, y = (own.select(F.col("ck").alias(e), F.col("lender").alias(f"lender_{e}"), F.col("items").alias(items)) for e, items in (("a", "x"), ("b", "y")))
        both = filtered.join(x, ["a", "lender_a"]).join(y, ["b", "lender_b"])
        common = F.size(F.array_intersect("x", "y"))
        return materialize(both.where(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b").distinct(), "sets", TEXT_ROWS)

    salt = F.lit(_SALTS[2])
    heads = lists.groupBy("token").agg(F.min("ck").alias("first"), F.max("ck").alias("last"), F.min(F.col("ck").bitwiseXOR(salt)).alias("mid"))
    first = lists.join(heads, "token").select("ck", F.explode(F.array_distinct(F.array("first", "last", F.col("mid").bitwiseXOR(salt)))).alias("pivot"))
    first = first.where("ck <> pivot").select(F.least("ck", "pivot").alias("a"), F.greatest("ck", "pivot").alias("b"))
    tried = materialize(first.unionByName(couples).distinct(), "pairs")
    links = verified(tried, "links")
    roots = connected_components(links)

    def open_lists() -> DataFrame:
        """Lists that hold more than one component, with the root of each class."""
        rooted = lists.join(roots.select(F.col("node").alias("ck"), "root"), "ck", "left").withColumn("root", F.coalesce("root", "ck"))
        rooted = materialize(rooted, "rooted")
        several = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("token")
        return rooted.join(several, "token")

    for k in range(PIVOT_ROUNDS if spanning else 0):
        mixed_lists = open_lists()
        salt = F.lit(_SALTS[k] ^ 0x7F4A7C15)
        pivots = mixed_lists.groupBy("token").agg(F.min(F.col("ck").bitwiseXOR(salt)).alias("low"), F.max(F.col("ck").bitwiseXOR(salt)).alias("high"))
        pivots = pivots.select("token", F.explode(F.array(F.col("low").bitwiseXOR(salt), F.col("high").bitwiseXOR(salt))).alias("pivot"))
        more = mixed_lists.select("token", "ck", "root").join(pivots, "token").where("ck <> pivot")
        more = more.join(roots.select(F.col("node").alias("pivot"), F.col("root").alias("other")), "pivot", "left").where("root <> coalesce(other, pivot)")
        more = more.select(F.least("ck", "pivot").alias("a"), F.greatest("ck", "pivot").alias("b")).distinct().join(tried, ["a", "b"], "leftanti")
        more = materialize(more, "pairs")
        if more.isEmpty():
            continue
        tried = tried.unionByName(more)
        links = links.unionByName(verified(more, "links"))
        roots = connected_components(links)

    rest = open_lists() if spanning else lists.withColumn("root", F.col("ck"))
    rest = rest.join(classes.select("ck", *_MARKS), "ck")
    one, two = (rest.select("token", F.col("ck").alias(x), F.col("n").alias(f"n_{x}"), F.col("pos").alias(f"pos_{x}"), F.col("root").alias(f"root_{x}"), *[F.col(s).alias(f"{x}{k}") for k, s in enumerate(_MARKS)]) for x in "ab")
    bound = f"{100 + percent} * least(n_a - pos_a, n_b - pos_b) >= {percent} * (n_a + n_b)"
    pairs = one.join(two, "token").where(f"a < b and root_a <> root_b and {length} and {bound} and {may_reach(percent)}").select("a", "b").distinct()
    pairs = materialize(pairs.join(tried, ["a", "b"], "leftanti"), "pairs")
    if not pairs.isEmpty():
        links = links.unionByName(verified(pairs, "links"))
        roots = connected_components(links)
    return Join(keyed.select("doc_id", "n", "ck"), classes, links, roots.withColumnRenamed("node", "ck"))


def class_components(joined: Join) -> DataFrame:
    """(ck, n, component_id, root, rows): for each class the least id of its component, and the rows of the component."""
    rooted = joined.classes.join(joined.roots, "ck", "left").withColumn("root", F.coalesce("root", "ck"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"), F.sum("size").alias("rows"))
    return rooted.select("ck", "n", "root").join(least, "root")


def components(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, component_rows for every row of documents."""
    joined = similarity_join(documents, width, percent, spanning=True)
    found = joined.keyed.join(class_components(joined).select("ck", "n", "component_id", "rows"), ["ck", "n"], "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.coalesce("rows", F.lit(1)).alias("component_rows"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Pipeline stage: of each component the row with the smallest id stays (of rows that share it, one with the least hash of its text).

    Rows whose class is surely alone pass without a shuffle; a bitmap of the other classes tells.
    """
    joined = similarity_join(docs, width, percent, spanning=True)
    several = class_components(joined).where("rows > 1")
    several = materialize(several.select(F.col("ck").alias("__class"), F.col("n").alias("__size"), F.col("root").alias("__root"), F.col("component_id").alias("__least")), "several")
    bits = spark.sparkContext.broadcast(bitmap(several.select("__class")))

    @F.arrow_udf("ck long, n long, maybe boolean")
    @lean
    def classed(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for texts in steps(column_texts(column)):
                hashes, counts = shingle_hashes(texts, width)
                keys = class_keys(hashes, counts)
                values = [pa.array(keys), pa.array(counts, pa.int64()), pa.array((counts > 0) & in_bitmap(bits.value, keys))]
                yield pa.StructArray.from_arrays(values, ["ck", "n", "maybe"])

    marked = docs.withColumn("__c", classed("text"))
    alone = marked.where(~F.col("__c.maybe")).select(*docs.columns)
    rest = marked.where(F.col("__c.maybe")).withColumn("__class", F.col("__c.ck")).withColumn("__size", F.col("__c.n")).join(several, ["__class", "__size"], "left")
    single = rest.where(F.col("__root").isNull()).select(*docs.columns)
    first = rest.where(F.col("__root").isNotNull() & F.col("doc_id").eqNullSafe(F.col("__least")))
    first = first.withColumn("__n", F.row_number().over(Window.partitionBy("__root").orderBy(F.xxhash64("text")))).where("__n = 1").select(*docs.columns)
    return alone.unionByName(single).unionByName(first)
