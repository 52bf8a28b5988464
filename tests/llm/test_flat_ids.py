"""Ids of many words lie in one row: they are those of the library, also when the kept words are dropped and for characters without a piece."""

import numpy as np
import pytest
import sentencepiece

from starloom.llm import alignment, pieces, tokens


def odd_texts(rng, n):
    letters = "abcdeth in▁ gs.,é日\n𝄞Åﬁ\0"
    return ["", " ", "▁", "x" * 70 + "日𝄞", "a" * (pieces.LONG + 5), *("".join(rng.choice(list(letters), rng.integers(0, 50))) for _ in range(n))]


@pytest.mark.parametrize("most", [1, 50, 400_000])
def test_flat_ids_are_those_of_the_library(monkeypatch, most):
    monkeypatch.setattr(pieces, "MOST_WORDS", most)
    path = tokens.tokenizer_path("piece_bpe_32k.model")
    library, v, rng = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Vocabulary(path), np.random.default_rng(most)
    for _ in range(4):
        texts = odd_texts(rng, 60)
        ids, ends = v.encode_all(texts)
        expected = [library.encode(t) for t in texts]
        assert [x.tolist() for x in np.split(ids, ends)[:-1]] == expected
        assert v.decode_all([np.array(x, np.int64) for x in expected]) == [library.decode(x) for x in expected]
        assert [v.said(np.array(x, np.int64)) for x in expected] == [",".join(map(str, x)).encode() for x in expected]
    assert v.encode_all([])[1].tolist() == [] and v.encode([]) == [] and v.decode_all([]) == []


def test_links_without_a_search():
    rng = np.random.default_rng(5)
    for n in range(40):
        total = int(rng.integers(1, 60))
        ends_a, ends_b = (np.append(np.sort(rng.choice(total, int(rng.integers(0, total)), replace=False)), total) for _ in "ab")
        ends = np.union1d(ends_a, ends_b)
        a, b = alignment.links(ends_a, ends_b)
        assert a.tolist() == np.searchsorted(ends_a, ends).tolist() and b.tolist() == np.searchsorted(ends_b, ends).tolist()
    none = np.zeros(0, np.int64)
    assert [x.tolist() for x in alignment.links(none, none)] == [[], []]
