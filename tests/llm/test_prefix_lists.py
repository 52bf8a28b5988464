import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import jaccard
from test_llm_operators import brute_components


def batches(rows, cuts):
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        columns = list(zip(*rows[a:b])) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))], ["token", "ck", "n", "pos", "salt"])


def test_lists_of_one_class_are_dropped_wherever_batches_end():
    """Repeated classes, salted lists of one class, empty batches, lists over several batches."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        rows = sorted((int(t), 0 if t % 3 else 1 + int(c) % 2, int(c), 5, 1) for t, c in zip(rng.integers(0, 6, 20), rng.integers(0, 4, 20)))
        rows = [(t, c, n, p, s) for t, s, c, n, p in rows]
        cuts = sorted(rng.integers(0, len(rows) + 1, rng.integers(0, 6)).tolist())
        found = [(r["token"], r["ck"]) for b in jaccard._shared(batches(rows, cuts)) for r in b.to_pylist()]
        classes = {}
        for t, c, *_, s in rows:
            classes.setdefault((t, s), set()).add(c)
        expected = sorted((t, c) for (t, s), held in classes.items() if s or len(held) > 1 for c in held)
        assert sorted(found) == expected


@pytest.mark.parametrize("hot_level", [0, 12, 120])
def test_links_do_not_depend_on_salts(spark, hot_level):
    rng = np.random.default_rng(8)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 300, 50)) for _ in range(2)]
    texts = ["", "one two"]
    for k in range(30):
        w = base[k % 2].split()
        for p in rng.integers(0, 50, rng.integers(0, 4)):
            w[p] = f"n{rng.integers(0, 999)}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    joined = jaccard.similarity_join(docs, hot_level=hot_level)
    least = {r["ck"]: r["component_id"] for r in jaccard.class_components(joined).collect()}
    found = [least.get(r["ck"], r["doc_id"]) for r in joined.keyed.orderBy("doc_id").collect()]
    assert found == brute_components(texts)[1]
