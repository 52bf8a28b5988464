"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, word pairs and pairs that skip one word; each counts 1, so that one
insult weighs as much in a long text as in a short one. Features are made in parallel; the updates, each of which needs the one
before, run in one task over a sample of at most SAMPLE_ROWS rows (averaging models of parts of it lost a third of the recall).
L1 leaves a few hundred non-zero weights, at most SLOTS, which are broadcast.

Null or empty text has no features and gets the score of the bias. Rows with a null id or label, or an id whose labels disagree,
are not learned from. Rows may repeat: each is scored by its own text. Without a row to learn from every score is 0. Extra columns are ignored by scores() and kept by keep_clean().
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, frame_steps, lean, mixed, reachable, steps, table, word_hashes

SLOTS = 1 << 18
#: Labelled rows that are learned from at most: those with the smallest hashes of their ids.
SAMPLE_ROWS = 12_000
THRESHOLD = 0.7


@dataclass
class Model:
    slots: np.ndarray
    weights: np.ndarray
    bias: float


def feature_slots(texts: list[str]) -> list[np.ndarray]:
    """The distinct feature slots of each text."""
    words, counts = word_hashes(texts, "nonword")
    ends = np.cumsum(counts)
    text_of = np.repeat(np.arange(len(texts)), counts)
    parts, owners = [words], [text_of]
    for skip, factor in ((1, 0x8EBC6AF09C88C6E3), (2, 0x589965CC75374CC3)):
        if len(words) > skip:
            same = text_of[skip:] == text_of[:-skip]
            parts.append(mixed(words[:-skip] * np.uint64(factor) + words[skip:])[same])
            owners.append(text_of[skip:][same])
    slot = np.concatenate(parts) >> np.uint64(64 - SLOTS.bit_length() + 1)
    key = np.unique(np.concatenate(owners).astype(np.uint64) * np.uint64(SLOTS) + slot)
    cut = np.searchsorted(key, np.arange(1, len(ends) + 1, dtype=np.uint64) * np.uint64(SLOTS))
    return np.split((key % np.uint64(SLOTS)).astype(np.int32), cut[:-1]) if len(ends) else []


def ftrl(rows: list[tuple[np.ndarray, int]], epochs: int = 5, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.0) -> tuple[np.ndarray, float]:
    """Per-coordinate FTRL-proximal over rows of (slots, label); the bias has no L1."""
    z, n = np.zeros(SLOTS), np.zeros(SLOTS)
    bz = bn = bias = 0.0
    for _ in range(epochs):
        for slots, label in rows:
            zs, ns = z[slots], n[slots]
            root = np.sqrt(ns)
            w = np.where(np.abs(zs) > l1, (np.sign(zs) * l1 - zs) / ((beta + root) / alpha + l2), 0.0)
            bias = -bz / ((beta + bn**0.5) / alpha)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -30, 30)))
            g = p - label
            z[slots] = zs + g - (np.sqrt(ns + g * g) - root) / alpha * w
            n[slots] = ns + g * g
            bz += g - ((bn + g * g) ** 0.5 - bn**0.5) / alpha * bias
            bn += g * g
    w = np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)
    return w, bias


def labelled_sample(documents: DataFrame, labels: DataFrame, target: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label, text) of at most `rows` labelled ids outside the held-out third; the sample has a bounded size and is broadcast as ids."""
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & (crc_mod("doc_id", 3) != 1))
        .groupBy("doc_id").agg(F.min(target).alias("label"), F.max(target).alias("_most"))
        .where("label = _most").select("doc_id", F.col("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    return documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])


@lean
def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows, texts in frame_steps(batches):
        yield pd.DataFrame({"doc_id": rows["doc_id"], "label": rows["label"], "slots": [s.tobytes() for s in feature_slots(texts)]})


@lean
def _train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The weights of the rows of a task, which come a batch at a time; only their slots are kept."""
    rows = [(int(i) * 0x9E3779B97F4A7C15 % (1 << 64), np.frombuffer(s, np.int32), int(y)) for b in batches for i, s, y in zip(b["doc_id"], b["slots"], b["label"], strict=True)]
    if not rows:
        return
    rows.sort(key=lambda row: row[0])
    w, bias = ftrl([row[1:] for row in rows])
    kept = np.flatnonzero(w)
    yield pd.DataFrame({"slot": np.append(kept, -1).astype(np.int64), "weight": np.append(w[kept], bias)})


def train(documents: DataFrame, labels: DataFrame, target: str = "toxic") -> Model:
    """The non-zero weights, at most SLOTS, and the bias (slot -1) reach the driver."""
    reachable(documents.sparkSession)
    sample = labelled_sample(documents, labels, target).mapInPandas(_features, "doc_id long, label int, slots binary")
    found = sample.repartition(1).mapInPandas(_train, "slot long, weight double").toPandas().sort_values("slot")
    if found.empty:
        return Model(np.zeros(0, np.int64), np.zeros(0), -math.inf)
    return Model(found["slot"].to_numpy()[1:], found["weight"].to_numpy()[1:], float(found["weight"].iloc[0]))


def score_column(spark: SparkSession, model: Model):
    """A function column -> probability of label 1; the model travels as a broadcast of at most 2 MB."""
    reachable(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    @lean
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = np.zeros(SLOTS)
        weights[shared.value.slots] = shared.value.weights
        for part in parts:
            logits = [weights[s].sum() + shared.value.bias for held in steps(part) for s in feature_slots(held)]
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(np.array(logits, dtype=float), -700, 700))))

    return score


def scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of documents."""
    score = score_column(documents.sparkSession, train(documents, labels))
    out = documents.select("doc_id", score("text").alias("score"))
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose score reaches the threshold go."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return docs.where(score_column(spark, model)(F.col("text")) < THRESHOLD)
