"""Stages of the pipeline leave small batches to whoever runs their frame; the whole pipeline puts the session's setting back."""

import pytest

import corpus_pipeline
from starloom.llm import toxicity
from starloom.session import TEXT_ROWS

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture
def tables(spark, tmp_path):
    docs = [(i, f"word{i} some text of document {i} with key words {'idiot' if i % 2 else 'friend'}") for i in range(40)]
    spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 1) for i, _ in docs], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.conf.get(KEY)
    spark.conf.set(KEY, 10_000)
    yield str(tmp_path)
    spark.conf.set(KEY, before)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_frames_of_stages_run_in_small_batches(spark, tables, stage):
    frame = stage(spark, spark.read.parquet(f"{tables}/documents.parquet"), tables)
    assert 0 < int(spark.conf.get(KEY)) <= TEXT_ROWS
    assert frame.count() > 0


def test_pipeline_puts_the_setting_back(spark, tables):
    corpus_pipeline.run(spark, tables)
    assert spark.conf.get(KEY) == "10000"


def test_training_reads_its_rows_batch_by_batch(spark, tables):
    """The same weights whatever the batches."""
    docs, labels = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    whole = toxicity.train(docs, labels)
    spark.conf.set(KEY, 3)
    few = toxicity.train(docs, labels)
    assert whole.bias == few.bias and whole.slots.tolist() == few.slots.tolist() and whole.weights.tolist() == few.weights.tolist()
    empty = toxicity.train(docs.where("doc_id < 0"), labels)
    assert len(empty.slots) == 0 and empty.bias == float("-inf")
