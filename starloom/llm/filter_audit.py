"""Filter interaction audit by wide packed counters.

Five filters give every document a mask of those it fails. For each mask a big integer holds, in fields of 64 bits, what happens to a document
with that mask at each of the 600 steps (120 orders of five filters): kept after it, removed by it, failing but removed earlier, failing this
filter only. The integers of a part's documents are added up, all of them and those of good and of toxic documents apart; a sum of fewer than
2^64 ones can't run over into the next field. The sums are unpacked to one row for each part and step. Documents of one part, mask and label
are counted before they meet, so a part reaches its task as at most 128 numbers, however large it is.

Null text is empty, a null or absent source is the empty string. Rows may repeat: each is a document. Equal texts are found by SHA-256; a row
is a copy if any smaller id has its text, so rows that share an id are not copies of one another, and a null id counts as larger than
any other. Repeated labels of an id count as their largest, null labels and labels of null ids as none. An empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .blocks import HOT_ROWS, SHARE
from .common import reachable, table

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: What a field of a step says about a document.
KEPT, REMOVED, REDUNDANT, UNIQUE = range(4)
OUTCOMES = 4
FIELD = 64
_FIELDS = len(ORDERS) * len(FILTERS) * OUTCOMES
AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


@lru_cache(maxsize=1 << len(FILTERS))
def packed(mask: int) -> int:
    """The outcomes of all steps for a document that fails the filters of the mask (bit i: FILTERS[i])."""
    whole, place = 0, 0
    for order in ORDERS:
        gone = False
        for letter in order:
            bit = 1 << FILTERS.index(letter)
            fails = bool(mask & bit)
            outcomes = {REMOVED: fails and not gone, REDUNDANT: fails and gone, UNIQUE: mask == bit}
            gone = gone or fails
            outcomes[KEPT] = not gone
            whole |= sum(1 << FIELD * (place + k) for k, holds in outcomes.items() if holds)
            place += OUTCOMES
    return whole


def unpacked(total: int) -> np.ndarray:
    """The fields of a sum, a row a step."""
    return np.frombuffer(total.to_bytes(_FIELDS * FIELD // 8, "little"), "<u8").astype(np.int64).reshape(-1, OUTCOMES)


def _audit(key: tuple, classes: pd.DataFrame) -> pd.DataFrame:
    numbers = list(zip(classes["mask"].tolist(), classes["good"].tolist(), classes["toxic"].tolist(), classes["n"].tolist(), strict=True))
    if sum(n for *_, n in numbers) >= 1 << FIELD - 1:
        raise OverflowError("more documents than a field counts")
    every = unpacked(sum(n * packed(m) for m, _, _, n in numbers))
    good = unpacked(sum(n * packed(m) for m, g, _, n in numbers if g))
    toxic = unpacked(sum(n * packed(m) for m, _, t, n in numbers if t))
    letter = np.array([FILTERS.index(c) for order in ORDERS for c in order])
    shapley = np.array([every[letter == k, REMOVED].sum() for k in range(len(FILTERS))])
    return pd.DataFrame({
        "part": key[0], "filter_order": np.repeat(ORDERS, len(FILTERS)), "step": np.tile(np.arange(1, len(FILTERS) + 1), len(ORDERS)),
        "kept": every[:, KEPT], "removed": every[:, REMOVED], "redundant": every[:, REDUNDANT], "unique_fails": every[:, UNIQUE],
        "good_lost": good[:, REMOVED], "toxic_lost": toxic[:, REMOVED], "shapley": shapley[letter],
    })


def failures(documents: DataFrame, hot_rows: int = HOT_ROWS, share: int = SHARE) -> DataFrame:
    """doc_id, part and mask for every row of documents."""
    text = F.coalesce("text", F.lit(""))
    source = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in documents.columns else F.lit("")
    words = documents.select("doc_id", source.alias("part"), text.alias("t"), F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("w"))
    fails = [
        F.size("w") < 200,
        100 * F.size(F.array_distinct("w")) < 50 * F.size("w"),
        100 * F.regexp_count("t", F.lit("[A-Z]")) > 2 * F.char_length("t"),
        F.col("t").rlike("[#$%&*|]"),
    ]
    mask = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    own = materialize(words.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("sha")), "masks")
    copies = own.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1 and first is not null")
    copies = materialize(copies, "copies")
    limit = max(hot_rows, own.count() // share)  # at most `share` texts have more rows
    hot = F.broadcast(copies.where(F.col("rows") > limit).select("sha", "first"))
    again = F.coalesce(F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first")), F.lit(False)) & F.col("first").isNotNull()
    alone = own.join(hot.select("sha"), "sha", "left_anti").join(copies.where(F.col("rows") <= limit).select("sha", "first"), "sha", "left")
    both = alone.select("doc_id", "part", "mask", "first").unionByName(own.join(hot, "sha").select("doc_id", "part", "mask", "first"))
    return both.select("doc_id", "part", (F.col("mask") + F.when(again, 1 << 4).otherwise(0)).alias("mask"))


def audit(documents: DataFrame, labels: DataFrame, hot_rows: int = HOT_ROWS, share: int = SHARE) -> DataFrame:
    """600 rows for every part: see AUDIT."""
    reachable(documents.sparkSession)
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic")).where("quality = 1 or toxic = 1")
    judged = failures(documents, hot_rows, share).join(marked, "doc_id", "left")
    classes = judged.groupBy("part", "mask", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic")).agg(F.count(F.lit(1)).alias("n"))
    return classes.groupBy("part").applyInPandas(_audit, AUDIT)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
