"""Texts of a batch are handed on in steps, so that a worker holds no second copy of a batch."""

import pyarrow as pa
import pytest

from starloom.llm import secret_scan
from starloom.llm.common import STEP_BYTES, column_texts


def test_masked_texts_leave_in_steps():
    texts = ["word " * 20_000 + f"password=hunter{i:04d}" for i in range(8)] + [None, "", "token: abcdefgh"]
    parts = list(secret_scan.masked_steps(iter([pa.array(texts), pa.array([], pa.string())])))
    assert len(parts) > 3 and all(sum(len(t or "") for t in p.to_pylist()) <= STEP_BYTES for p in parts)
    want = [None if t is None else secret_scan.redacted(t, secret_scan.shard_spans([t], secret_scan.RULES)[0]) for t in texts]
    assert [t for p in parts for t in p.to_pylist()] == want


def test_redact_keeps_rows_whose_batch_has_several_steps(spark):
    rows = [(i, None if i == 3 else "x " * 70_000 + "secret=abcdef123") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["text"] for r in secret_scan.redact(spark, docs, "").collect()}
    assert got == {i: None if t is None else "x " * 70_000 + "[secret]" for i, t in rows}


@pytest.mark.parametrize("n", [0, 1, 256, 700])
def test_column_texts_are_those_of_the_column(n):
    texts = [None if i % 7 == 3 else f"t{i}" for i in range(n)]
    assert list(column_texts(pa.array(texts, pa.string()))) == texts
