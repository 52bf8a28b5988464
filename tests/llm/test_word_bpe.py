import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from starloom.llm import blocks, wordbpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=wordbpe.read_ranks(PATH), special_tokens={})
TEXTS = ["", None, " ", "  \n\t ", "a", "it's John's 2nd  word\n\n\nand\x1c\x85 x", "<|endoftext|> <s>", "日本語 é́  x \U00016ea0՘ \U0001f600", "x" * 20_000, "word salad " * 3000, "word salad " * 3000, "'ſ 'S 'll"]


def frame(spark, texts=TEXTS):
    """Ids with a null and a repeat, and extra columns that clash with the operator's own."""
    rows = [(None if i == 3 else i, t, 5, "w") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[4:5], "doc_id long, text string, k int, word string")


def test_varints_round_trip():
    values = np.array([0, 1, 127, 128, 300, 16383, 16384, 1 << 30, (1 << 62) + 5], np.int64)
    data, ends = blocks.varints(values)
    assert blocks.unvarints(data).tolist() == values.tolist() and ends[-1] == len(data)
    assert blocks.unvarints(blocks.varints(values[:0])[0]).tolist() == []
    assert blocks.ragged(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert blocks.binaries(np.frombuffer(b"abc", np.uint8), np.array([1, 1, 3])).to_pylist() == [b"a", b"", b"bc"]


def test_packed_strings_round_trip():
    for parts in ([b""], [b"a", b"", b"bc" * 900], []):
        assert blocks.unpacked(blocks.packed(*parts)) == parts


def test_blocks_are_whole_over_batches():
    parts = [pa.RecordBatch.from_arrays([pa.array(b, pa.int64())], ["block"]) for b in ([1, 1], [], [1, 2], [3])]
    assert [t["block"].to_pylist() for t in blocks.whole_blocks(parts)] == [[1, 1, 1], [2], [3]]


@pytest.mark.parametrize("block_chars, buckets", [(1 << 22, None), (64, 3)])
def test_equals_the_library(spark, block_chars, buckets):
    """One block or many, many buckets or few."""
    rows = wordbpe.encode_and_decode(frame(spark).repartition(3), block_chars=block_chars, buckets=buckets).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        text = TEXTS[3 if r["doc_id"] is None else r["doc_id"]] or ""
        assert r["ids"] == LIBRARY.encode_ordinary(text) and bytes(r["decoded"]) == text.encode()


def test_digests_and_decoding(spark):
    made = wordbpe.encode_and_decode(frame(spark))
    found = {r["doc_id"]: bytes(r["decoded"]) for r in wordbpe.decode(made).collect()}
    for r in wordbpe.encode_and_decode(frame(spark), digests=True).collect():
        text = TEXTS[3 if r["doc_id"] is None else r["doc_id"]] or ""
        ids = LIBRARY.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest() and found[r["doc_id"]] == text.encode()
    assert wordbpe.encode_and_decode(frame(spark).limit(0)).count() == 0


def test_words_are_cut_as_the_library_cuts_them():
    """Every character whose class differs, and random mixtures of them with others."""
    strange = wordbpe.stand_ins()
    cut = wordbpe.Splitter(public_tokenizers.PATTERN, strange)
    own = lambda t: [i for w in cut(t) for i in LIBRARY._core_bpe.encode_single_piece(w.encode())]
    rng, letters = np.random.default_rng(4), "ab '\n\t s1é日.\x85\x1c " + "".join(map(chr, sorted(strange)[:300]))
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1 {chr(c)}'s" for c in sorted(strange)[::37]]
    texts += ["".join(letters[i] for i in rng.integers(0, rng.choice([12, len(letters)]), rng.integers(1, 40))) for _ in range(3000)]
    assert all(own(t) == LIBRARY.encode_ordinary(t) for t in texts)
    assert regex.findall(public_tokenizers.PATTERN, "it's 12") == cut("it's 12")


def test_query_over_a_whole_table(spark):
    rows = {r["doc_id"]: r for r in wordbpe.op12_word_bpe(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = LIBRARY.encode_ordinary(d["text"] or "")
        r = rows[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()
