import duckdb
import numpy as np
import pytest

import corpus_pipeline
from starloom.llm import jaccard, queries
from starloom.llm.common import shingle_hashes

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", range(7))
def test_steps_of_few_words(n):
    """A step may hold fewer words than a shingle has: all of them are one shingle."""
    text = " ".join("abcdefg"[:n])
    hashes, counts = shingle_hashes([text])
    assert counts.tolist() == [0 if n == 0 else max(n - 4, 1)] and len(hashes) == counts.sum()
    both = shingle_hashes([text, "", text.upper()])
    assert both[1].tolist() == [*counts, 0, *counts] and (both[0] == np.concatenate((hashes, hashes))).all()


def test_partitions_of_few_words(spark):
    """One document a partition, of no to six words, null among them; ids may be null and extra columns clash."""
    texts = ["", None, "a", "a b", "A b", "a b c", "a b c d", "a b c d e", "a b c d e f"]
    rows = [(None if i == 6 else i, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ck int").repartition(len(texts))
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.components(docs).collect()}
    assert found == {0: (0, 0), 1: (0, 1), 2: (1, 2), 3: (1, 3), 4: (1, 3), 5: (1, 5), None: (1, None), 7: (1, 7), 8: (2, 8)}
    assert sorted(r["ck"] for r in jaccard.keep_one(spark, docs, "").collect()) == [0, 1, 2, 3, 5, 6, 7, 8]


def test_pipeline_of_short_texts(spark, tmp_path):
    """Short, null and empty texts, a null id, a repeated row and extra columns go through all stages."""
    rows = [(1, "a b", None, None, 3), (2, None, "en", "s", None), (3, "", "en", "s", 0), (None, "one two three", "en", "s", 13), (5, "x y z", "de", "s", 5), (5, "x y z", "de", "s", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema).selectExpr("*", "7 AS score", "'q' AS component_id")
    for k, docs in enumerate((frame, frame.limit(0))):
        docs.repartition(3).write.parquet(f"{tmp_path}/{k}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{k}/labels.parquet")
        pieces = corpus_pipeline.run(spark, f"{tmp_path}/{k}").collect()
        assert all(r["start"] == 0 and r["length"] == r["doc_tokens"] for r in pieces)
        if k:
            assert not pieces


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_agrees_with_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    found = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    result = con.execute(queries.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted(tuple(str(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert sorted(tuple(str(r[c]) for c in columns) for r in found.collect()) == expected
