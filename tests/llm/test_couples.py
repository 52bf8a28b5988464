"""Lists of two classes become pairs at once, wherever batches end; sets of shingles are shuffled once and never written."""

import numpy as np
import pytest

from starloom.llm import jaccard
from starloom.session import materialize
from test_llm_operators import brute_components
from test_prefix_lists import batches


def test_lists_of_two_classes_are_one_row_wherever_batches_end():
    rng = np.random.default_rng(2)
    rows_given = rows_shared = 0
    for _ in range(300):
        rows = sorted((int(t), 0 if t % 3 else 1 + int(c) % 2, int(c), 5, 1) for t, c in zip(rng.integers(0, 12, 30), rng.integers(0, 5, 30)))
        rows = [(t, c, n, p, s) for t, s, c, n, p in rows]
        cuts = sorted(rng.integers(0, len(rows) + 1, rng.integers(0, 6)).tolist())
        found = [r for b in jaccard._lists(batches(rows, cuts)) for r in b.to_pylist()]
        shared = [(r["token"], r["ck"]) for b in jaccard._shared(batches(rows, cuts)) for r in b.to_pylist()]
        assert sorted([(r["token"], r["ck"]) for r in found] + [(r["token"], r["other"]) for r in found if r["other"] is not None]) == sorted(shared)
        for r in found:
            if r["other"] is not None:
                assert r["token"] % 3 and [c for t, c in sorted(shared) if t == r["token"]] == [r["ck"], r["other"]]
        rows_given, rows_shared = rows_given + len(found), rows_shared + len(shared)
    assert rows_given < 0.95 * rows_shared


@pytest.mark.parametrize("spanning", [False, True])
def test_sets_are_never_written(spark, monkeypatch, spanning):
    rng = np.random.default_rng(3)
    texts = ["", None, "one two"]
    for k in range(12):
        base = rng.integers(0, 10_000, 60)
        for n in range(1 + k % 4):
            w = base.copy()
            w[rng.integers(0, 60, n)] = 20_000 + n
            texts.append(" ".join(f"w{x}" for x in w))
    written = []

    def noted(df, *rest):
        written.append(df)
        return materialize(df, *rest)

    monkeypatch.setattr(jaccard, "materialize", noted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    joined = jaccard.similarity_join(docs, spanning=spanning)
    least = {r["ck"]: r["component_id"] for r in jaccard.class_components(joined).collect()}
    found = [least.get(r["ck"], r["doc_id"]) for r in joined.keyed.orderBy("doc_id").collect()]
    assert found == brute_components([t or "" for t in texts])[1]
    assert len(written) > 4 and not any(t.startswith("array") for df in written for _, t in df.dtypes)
