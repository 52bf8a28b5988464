"""Language: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed code point n-grams (1 to 3) of the lower-cased text, weighted by 1 + log(count) and inverse document frequency and
scaled to length 1. Document frequencies cover every row that may be learned from; the weights are fitted on a bounded sample with
follow-the-regularised-leader and an elastic net (L1 and L2), the temperature on a part of the sample kept apart.

Null text, or one without a letter, is `und` with score 0. Rows with a null id or lang are not learned from. Without any row to learn
from, everything is `und`. Repeated rows are predicted alike. Extra columns are ignored by predictions() and kept by keep_known().
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import crc_mod, lean, mixed, reachable, table

SLOTS = 1 << 16
#: Rows of each language that weights are fitted on at most: those with the smallest hashes of their ids.
SAMPLE_ROWS = 3_000
SHARDS = 4
UNDETERMINED = "und"
#: Below this calibrated probability the pipeline rejects a document.
LEAST_SCORE = 0.5
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the character n-grams of a text and how often each occurs."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    parts = [c.astype(np.uint64) + np.uint64(1 << 62)]
    if len(c) > 1:
        two = parts[0][:-1] << np.uint64(21) | c[1:].astype(np.uint64)
        parts.append(two)
    if len(c) > 2:
        parts.append(parts[1][:-1] << np.uint64(21) | c[2:].astype(np.uint64) | np.uint64(1 << 63))
    slots = mixed(np.concatenate(parts)) >> np.uint64(64 - SLOTS.bit_length() + 1)
    counts = np.bincount(slots.astype(np.int64), minlength=SLOTS)
    kept = np.flatnonzero(counts)
    return kept, counts[kept]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    slots, counts = gram_counts(text)
    x = (1.0 + np.log(counts)) * idf[slots]
    return slots, x / max(np.sqrt((x * x).sum()), 1e-12)


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen, rows = np.zeros(SLOTS + 1, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            if isinstance(text, str):
                seen[gram_counts(text)[0]] += 1
                rows += 1
    seen[SLOTS] = rows
    kept = np.flatnonzero(seen)
    yield pd.DataFrame({"slot": kept, "df": seen[kept]})


def _trainer(languages: list[str], idf: np.ndarray, epochs: int = 2, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05):
    code = {v: i for i, v in enumerate(languages)}

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(order=[(int(i) * 0x9E3779B97F4A7C15) % (1 << 64) for i in rows["doc_id"]]).sort_values("order")
        k = len(languages)
        z, n = np.zeros((SLOTS + 1, k)), np.zeros((SLOTS + 1, k))
        data = []
        for text, lang in zip(rows["text"], rows["lang"], strict=True):
            slots, x = vector(text, idf)
            data.append((np.append(slots, SLOTS), np.append(x, 1.0)[:, None], code[lang]))

        def weights(zs, ns):
            return np.where(np.abs(zs) > l1, (np.sign(zs) * l1 - zs) / ((beta + np.sqrt(ns)) / alpha + l2), 0.0)

        for _ in range(epochs):
            for slots, x, y in data:
                zs, ns = z[slots], n[slots]
                w = weights(zs, ns)
                logit = (w * x).sum(axis=0)
                p = np.exp(logit - logit.max())
                p /= p.sum()
                p[y] -= 1.0
                g = x * p
                grown = ns + g * g
                z[slots] = zs + g - (np.sqrt(grown) - np.sqrt(ns)) / alpha * w
                n[slots] = grown
        w = weights(z, n)
        kept = np.flatnonzero(np.abs(w).sum(axis=1) > 0)
        out = pd.DataFrame({"slot": kept.astype(np.int64), "weights": [v.tolist() for v in w[kept]], "rows": len(rows)})
        return pd.concat([out, pd.DataFrame({"slot": [-1], "weights": [[0.0] * k], "rows": [len(rows)]})])

    return train


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _logits(text: str, model: Model) -> np.ndarray:
    slots, x = vector(text, model.idf)
    return x @ model.weights[slots] + model.bias


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm."""
    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(truth)), truth], 1e-12)).mean()

    low, high, ratio = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(documents: DataFrame) -> Model | None:
    """A model from rows whose crc32 is not 0 modulo 5, or None if there is none with a language."""
    spark = documents.sparkSession
    reachable(spark)
    rows = documents.select("doc_id", "text", "lang").where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod("doc_id", 5) != 0))
    df = rows.select("text").mapInPandas(lean(_frequencies), "slot long, df long").groupBy("slot").agg(F.sum("df").alias("df")).toPandas()
    seen = np.zeros(SLOTS + 1)
    seen[df["slot"].to_numpy()] = df["df"].to_numpy()
    if not seen[SLOTS]:
        return None
    idf = 1.0 + np.log((1.0 + seen[SLOTS]) / (1.0 + seen[:SLOTS]))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = rows.select("doc_id", "lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_ROWS).select("doc_id", "lang")
    sample = rows.join(F.broadcast(ids), ["doc_id", "lang"]).dropDuplicates(["doc_id"])
    languages = [r[0] for r in ids.select("lang").distinct().orderBy("lang").collect()]
    apart = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(10)) == 0
    shard = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(SHARDS)).alias("shard")
    fitted = sample.where(~apart).groupBy(shard).applyInPandas(_trainer(languages, idf), "slot long, weights array<double>, rows long").toPandas()
    weights, total = np.zeros((SLOTS + 1, len(languages))), max(1, fitted.loc[fitted["slot"] < 0, "rows"].sum())
    own = fitted[fitted["slot"] >= 0]
    if len(own):
        np.add.at(weights, own["slot"].to_numpy(), np.stack(own["weights"].to_numpy()) * (own["rows"].to_numpy() / total)[:, None])
    model = Model(languages, idf, weights[:SLOTS].astype(np.float32), weights[SLOTS], 1.0)
    shared = spark.sparkContext.broadcast(model)

    def calibration(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"lang": batch["lang"], "logits": pd.Series([_logits(t, shared.value).tolist() for t in batch["text"]], dtype=object, index=batch.index)})

    held = sample.where(apart).mapInPandas(lean(calibration), "lang string, logits array<double>").toPandas()
    if len(held) and len(languages) > 1:
        model.temperature = _temperature(np.stack(held["logits"].to_numpy()), held["lang"].map({v: i for i, v in enumerate(languages)}).to_numpy())
    return model


def prediction_column(spark: SparkSession, model: Model | None):
    """A function column -> struct(lang_pred, score)."""
    reachable(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    @lean
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for part in parts:
            found = []
            for text in part:
                if model is None or not isinstance(text, str) or not _LETTER.search(text):
                    found.append((UNDETERMINED, 0.0))
                    continue
                p = softmax(_logits(text, model)[None, :] / model.temperature)[0]
                found.append((model.languages[int(p.argmax())], float(p.max())))
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    return predict


def predictions(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of documents."""
    predict = prediction_column(documents.sparkSession, train(documents))
    out = documents.select("doc_id", predict("text").alias("p"))
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "p.lang_pred", "p.score")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(table(spark, sf_dir, "documents"))


def keep_known(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a language, or with an unsure one, go."""
    found = prediction_column(spark, train(docs))(F.col("text"))
    return docs.where((found["lang_pred"] != UNDETERMINED) & (found["score"] >= LEAST_SCORE))
