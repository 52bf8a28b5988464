"""Quality: regularised quadratic discriminant over transformed statistics of a document.

Counts and moments come from every labelled row outside the held-out third, as sums that Spark adds up. A class covariance is shrunk towards
the pooled one and towards a multiple of the identity; its Cholesky factor is computed once and gives Mahalanobis distance and determinant.
The score is the logistic function of the difference of log densities plus log prior odds.

Null text is empty. Rows with a null id or label, or an id whose labels disagree, are not learned from. With fewer than two classes every
score is the rate of label 1, 0 without labels. Repeated rows score alike. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import crc_mod, reachable, steps, table, utf8, word_hashes

TO_POOLED = 0.1
TO_IDENTITY = 0.01
THRESHOLD = 0.5
_CODE = np.arange(256)
_KINDS = {
    "upper": (_CODE >= 65) & (_CODE <= 90),
    "lower": (_CODE >= 97) & (_CODE <= 122),
    "digit": (_CODE >= 48) & (_CODE <= 57),
    "blank": (_CODE == 32) | ((_CODE >= 9) & (_CODE <= 13)),
    "line": _CODE == 10,
    "stop": np.isin(_CODE, list(b".,;:?")),
    "loud": _CODE == ord("!"),
    "odd": np.isin(_CODE, list(b"#$%&*@^~_=+<>|\\/{}[]")),
}
N_FEATURES = 15


def _duplicates(keys: np.ndarray, owner: np.ndarray, number: int) -> np.ndarray:
    """How many of each owner's keys repeat an earlier one."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    again = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    return np.bincount(o[1:][again], minlength=number)


def statistics(texts: list[str]) -> np.ndarray:
    """A row of N_FEATURES transformed statistics for each text."""
    raw = [utf8(t) for t in texts]
    n = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum(n)
    share = {}
    for name, kind in _KINDS.items():
        total = np.concatenate(([0], np.cumsum(kind[data])))
        share[name] = (total[ends] - total[ends - n]) / np.maximum(n, 1)
    words, counts = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    same = owner[1:] == owner[:-1]
    per_word = np.maximum(counts, 1)
    repeated = _duplicates(words, owner, len(texts)) / per_word
    pairs = (words[:-1] * np.uint64(0x8EBC6AF09C88C6E3) + words[1:])[same] if len(words) else words
    pair_owner = owner[1:][same] if len(words) else owner
    repeated_pairs = _duplicates(pairs, pair_owner, len(texts)) / per_word
    stutter = np.bincount(owner[1:][same & (words[1:] == words[:-1])], minlength=len(texts)) / per_word if len(words) else np.zeros(len(texts))
    lines = np.array([1.0 - len(set(x)) / len(x) if (x := t.split("\n")) else 0.0 for t in texts])

    def root(x):
        return np.arcsin(np.sqrt(np.clip(x, 0, 1)))

    return np.column_stack([
        np.log1p(n), np.log1p(counts), np.log1p(n / per_word), root(repeated), root(repeated_pairs), root(stutter), root(lines), *[root(share[k]) for k in _KINDS],
    ])


def with_statistics(documents: DataFrame) -> DataFrame:
    """doc_id, f (array<double>) for every row."""
    reachable(documents.sparkSession)

    @F.pandas_udf("array<double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([row for held in steps(part) for row in statistics(held)], dtype=object)

    return documents.select("doc_id", run("text").alias("f"))


@dataclass
class Model:
    means: np.ndarray
    factors: np.ndarray  # lower Cholesky factors of both covariances, inverted
    offset: float

    def scores(self, f: np.ndarray) -> np.ndarray:
        if not len(self.factors):
            return np.full(len(f), self.offset)
        log = [-0.5 * (((f - m) @ w.T) ** 2).sum(axis=1) + np.log(np.diag(w)).sum() for m, w in zip(self.means, self.factors, strict=True)]
        return 1.0 / (1.0 + np.exp(-np.clip(log[1] - log[0] + self.offset, -50, 50)))


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    d = N_FEATURES
    total = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        f, y = np.stack(batch["f"].to_numpy()) if len(batch) else np.zeros((0, d)), batch["label"].to_numpy()
        for k in (0, 1):
            x = f[y == k]
            total[k] += np.concatenate(([len(x)], x.sum(axis=0), (x.T @ x).reshape(-1)))
    label, cell = np.nonzero(np.ones_like(total))
    yield pd.DataFrame({"label": label, "cell": cell, "value": total.reshape(-1)})


def fit(features: DataFrame, labels: DataFrame, target: str = "quality") -> Model:
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & (crc_mod("doc_id", 3) != 1))
        .groupBy("doc_id").agg(F.min(target).alias("label"), F.max(target).alias("_most")).where("label = _most").select("doc_id", "label")
    )
    rows = features.join(known, "doc_id").select("f", "label")
    sums = rows.mapInPandas(_moments, "label int, cell int, value double").groupBy("label", "cell").agg(F.sum("value").alias("value")).toPandas()
    d = N_FEATURES
    total = np.zeros((2, 1 + d + d * d))
    total[sums["label"].to_numpy(), sums["cell"].to_numpy()] = sums["value"].to_numpy()
    n = total[:, 0]
    if n.min() < 2:
        return Model(np.zeros((0, d)), np.zeros((0, d, d)), float(n[1] / n.sum()) if n.sum() else 0.0)
    means = total[:, 1 : 1 + d] / n[:, None]
    scatter = total[:, 1 + d :].reshape(2, d, d) - np.einsum("k,ki,kj->kij", n, means, means)
    pooled = scatter.sum(axis=0) / n.sum()
    factors = []
    for k in (0, 1):
        shrunk = (1 - TO_POOLED) * scatter[k] / n[k] + TO_POOLED * pooled
        shrunk = (1 - TO_IDENTITY) * shrunk + TO_IDENTITY * (np.trace(pooled) / d + 1e-9) * np.eye(d)
        factors.append(np.linalg.inv(np.linalg.cholesky(shrunk)))
    return Model(means, np.stack(factors), float(np.log(n[1] / n[0])))


def scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of documents."""
    features = materialize(with_statistics(documents), "statistics")
    model = fit(features, labels)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(model.scores(np.stack(part.to_numpy())) if len(part) else np.zeros(0))

    out = features.select("doc_id", score("f").alias("score"))
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
