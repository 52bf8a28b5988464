"""Chunks a worker has not met before go through the library in a row, ids are counted as they are written, code words are placed two at a time."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from starloom.llm import tokenfile, tokens

TEXTS = ["Plain words, some twice, some not.\nA line", " Ünïcode été  two\tspaces", "日本 語 été x", "", " ", "a <|endoftext|> b <|x", "İ Ω ﬁ Ǆ ẞ ends", "no\x1cspace \x1cat 　 all", "</w> <w/> </w>"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_new_chunks_in_a_row(name):
    whole, mine = Tokenizer.from_file(tokens.tokenizer_path(name)), tokens.Encoder(tokens.tokenizer_path(name), markers=True)
    marked, plain = [], mine._marked
    mine._marked = lambda chunks: marked.extend(chunks) or plain(chunks)
    got = mine.encode(TEXTS)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [x.ids for x in whole.encode_batch_fast(TEXTS, add_special_tokens=False)]
    assert " words," in "".join(TEXTS) and not {b" words,", b" some", b" twice,", b" not.\nA"} & set(marked)
    many = [" ".join(f"w{k}é{k * k}" for k in range(1, 1000))]
    assert [np.frombuffer(x, "<u4").tolist() for x in mine.encode(many)] == [x.ids for x in whole.encode_batch_fast(many, add_special_tokens=False)]


def test_marks_where_bytes_do_not_add_up():
    mine, other = (tokens.Encoder(tokens.tokenizer_path("byte_bpe_50k.json"), markers=True) for _ in range(2))
    mine.bytes = mine.bytes + 1
    assert mine._joined([b" some", b" words"]) is None
    assert mine.encode(TEXTS) == other.encode(TEXTS)


def test_code_words_in_order():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 256, 257, 1000):
        ids = np.minimum(rng.zipf(1.2, n), 9000).astype("<u2")
        lengths = tokenfile.code_lengths(np.bincount(ids, minlength=9001))
        words = tokenfile.code_words(lengths)
        bits = "".join(format(int(words[i]), f"0{lengths[i]}b") for i in ids)
        payload, checkpoints = tokenfile.pack_bits(ids, words, lengths, 6)
        assert "".join(format(b, "08b") for b in payload) == bits + "0" * (-len(bits) % 8)
        assert checkpoints.tolist() == [int(lengths[ids[:k]].sum(dtype=np.int64)) for k in range(0, n, 6)]


def test_counts_are_written_with_the_ids(spark, tmp_path):
    path = str(tmp_path / "ids")
    texts = ["a b c", None, "", "b <|endoftext|> c", "日本"] * 3
    docs = spark.createDataFrame([(k if k % 4 else None, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    lengths = tokenfile.write_tokens(docs, path, markers=True)
    plain = spark.read.parquet(f"{path}/plain")
    ids = np.concatenate([np.frombuffer(r.ids, "<u2") for r in plain.where("counts is null").collect()])
    counted = [np.frombuffer(r.counts, "<i8") for r in plain.where("counts is not null").collect()]
    assert sum((c[c > 0].sum() for c in counted)) == len(ids)
    assert set(np.flatnonzero(lengths)) == set(ids.tolist())
    got = tokenfile.read_tokens(spark, path)
    assert got.count() == len(texts) and sum(r.n_tokens for r in got.collect()) == len(ids)
