"""A corpus pipeline: rejects toxic documents and those without a sure language, keeps one of each group of near copies, masks secrets, packs.

Each stage is written as Parquet in the shared folder and read again as the next one's documents. Texts reach Python workers in small batches.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import jaccard, language, packing, secret_scan, toxicity
from starloom.session import materialize, text_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage; whoever runs its frame does so with the small batches of text_batches()."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        text_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("toxicity", in_small_batches(toxicity.keep_clean)),
    ("language", in_small_batches(language.keep_known)),
    ("ngram_jaccard", in_small_batches(jaccard.keep_one)),
    ("secret_scan", in_small_batches(secret_scan.redact)),
    ("packing", in_small_batches(packing.pack_stage)),
]

#: Trained scores and packing can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences of all documents that stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), name)
    finally:  # the stages make it smaller
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    return docs
