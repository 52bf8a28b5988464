"""Texts reach Python workers in small batches where a frame is written; the session's own setting stays."""

import pytest

from starloom.llm import jaccard, packing
from starloom.session import TEXT_ROWS, materialize

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_batches_are_small_and_the_setting_stays(spark):
    before = spark.conf.get(KEY)

    def sizes(batches):
        for b in batches:
            yield b.assign(id=len(b)).head(1)

    frame = spark.range(0, 3 * TEXT_ROWS, 1, 1).mapInPandas(sizes, "id long")
    assert sorted(r.id for r in materialize(frame, "sizes", TEXT_ROWS).collect()) == [TEXT_ROWS] * 3
    assert materialize(frame, "sizes").first().id == 3 * TEXT_ROWS
    assert spark.conf.get(KEY) == before
    with pytest.raises(Exception):
        materialize(spark.range(1).mapInPandas(lambda b: 1 / 0, "id long"), "fails", TEXT_ROWS).collect()
    assert spark.conf.get(KEY) == before


def test_steps_that_read_texts_ask_for_small_batches(spark, monkeypatch):
    asked = {}

    def noted(df, name="table", batch_rows=None):
        asked[name] = batch_rows
        return materialize(df, name, batch_rows)

    docs = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "a b c d e f g h i j k"), (3, "x y")], "doc_id long, text string")
    monkeypatch.setattr(jaccard, "materialize", noted)
    monkeypatch.setattr(packing, "materialize", noted)
    assert len({r.component_id for r in jaccard.components(docs).collect()}) == 2
    assert packing.pack(docs).count() == 3
    assert all(0 < asked[name] <= 4 * TEXT_ROWS for name in ("keyed", "lists", "sets", "packing"))
