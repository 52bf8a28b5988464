"""Queries encode as the library's plain call does: a special token's string in a text is its special id."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from starloom.llm import packing, tokenfile, tokens

TEXTS = ["see <|endoftext|> here", "<|endoftext|>", "a<|endoftext|>b <|startoftext|> <| endoftext|>", "x  <|endoftext|>  y <|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext |>", "plain words", None]


def library(name):
    whole = Tokenizer.from_file(tokens.tokenizer_path(name))
    return lambda text: whole.encode(text or "", add_special_tokens=False).ids


def test_plain_encoding_equals_the_library():
    rng = random.Random(7)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", " ", "  ", "\n", "word", "É", "12", "'s", "<", "endoftext"]
    mixed = ["".join(rng.choices(bits, k=rng.randint(1, 9))) for _ in range(400)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        whole, cut = library(name), tokens.Encoder(tokens.tokenizer_path(name), markers=True)
        for t in [*TEXTS, *mixed]:
            assert np.frombuffer(cut.encode([t or ""])[0], "<u4").tolist() == whole(t), t


def saved(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return docs


def test_token_file_query(spark, tmp_path):
    saved(spark, tmp_path)
    whole, start = library("byte_bpe_50k.json"), 0
    for r in sorted(tokenfile.op3_token_file(spark, str(tmp_path)).collect(), key=lambda r: r["doc_id"]):
        ids = [*whole(TEXTS[r["doc_id"]]), tokenfile.END_ID]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_packing_query_and_stage(spark, tmp_path):
    docs, whole = saved(spark, tmp_path), library("word_bpe_49k.json")
    for out in (packing.op9_packing(spark, str(tmp_path)), packing.pack_stage(spark, docs, str(tmp_path))):
        rows = out.collect()
        assert len(rows) == len(TEXTS)
        for r in rows:
            ids = [*whole(TEXTS[r["doc_id"]]), packing.END_ID]
            assert (r["doc_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("most", [50, 1_500_000])
def test_chunks_kept_or_forgotten_give_the_ids_of_whole_texts(name, most):
    """Short, long and new chunks, white space of all kinds, NUL, empty texts, steps of any size."""
    rng = random.Random(most)
    pool = ["a", "b", " ", "  ", "\n", "\0", "é", "日本", "<|endoftext|>", "<|", " the", "'s", "123", "x" * 30, " " + "y" * 140, "\U0001f600", "́", "\x1c", "\x85", "Ab", " of", " in"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(700)]
    for markers in (True, False):
        mine, whole = tokens.Encoder(tokens.tokenizer_path(name), most, markers), Tokenizer.from_file(tokens.tokenizer_path(name))
        whole.encode_special_tokens = not markers
        for at in range(0, len(texts), 35):
            step = texts[at : at + 35]
            assert [np.frombuffer(x, "<u4").tolist() for x in mine.encode(step)] == [whole.encode(t, add_special_tokens=False).ids for t in step]
        assert mine.encode([]) == [] and mine.encode(["", ""]) == [b"", b""]
