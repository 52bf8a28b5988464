import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from starloom.llm import alignment
from starloom.llm.tokens import tokenizer_path

A = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
CHARS = alignment.byte_of_char()
TEXTS = ["", None, " ", "a", "  two  blanks \n\n\t end ", "The quick brown fox's 12,345 lazy dogs", "has ▁ in it", "<|endoftext|> and <s> </s>", "日本語 é́ \U0001f600", "x" * 3000, "word salad " * 2000, "word salad " * 2000, "\x00\x01 null", "naïve café — “quoted”"]


def bytes_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def plain(text):
    """(A ids, B ids, groups, links) by hand: cuts are the common ends, links all pairs that overlap."""
    none = [], [], [], []
    if not text:
        return none
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    parts_a, parts_b = [bytes(CHARS[c] for c in A.id_to_token(i)) for i in a], [bytes_b(i) for i in b]
    if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
        return none
    ends = [np.cumsum([len(p) for p in parts]).tolist() for parts in (parts_a, parts_b)]
    shared = sorted(set(ends[0]) & set(ends[1]))
    groups = [([i for i, e in zip(a, ends[0]) if low < e <= high], [i for i, e in zip(b, ends[1]) if low < e <= high]) for low, high in zip([0, *shared], shared)] if len(a) < 4000 else None
    found, j = [], 0
    for i, end in enumerate(ends[0]):
        start = ends[0][i - 1] if i else 0
        while j and ends[1][j - 1] > start:
            j -= 1
        while j < len(b) and (ends[1][j - 1] if j else 0) < end:
            if ends[1][j] > start:
                found.append((a[i], b[j]))
            j += 1
    return a, b, groups, found


def frame(spark, texts=TEXTS):
    """Ids with a null and a repeat, and extra columns that clash."""
    rows = [(None if i == 3 else i, t, 5, 1.0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[4:5], "doc_id long, text string, k int, n double")


@pytest.mark.parametrize("block_chars, hot_rows", [(1 << 22, None), (64, 1)])
def test_equals_brute_force(spark, block_chars, hot_rows):
    texts = TEXTS + TEXTS[4:5]
    known = [plain(t) for t in texts]
    held = Counter(p for *_, found in known for p in set(found))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(n, best.get(a, 0))
    rows = alignment.align(frame(spark).repartition(3), block_chars=block_chars, hot_rows=hot_rows).collect()
    assert len(rows) == len(texts)
    for r in rows:
        a, b, groups, found = known[3 if r["doc_id"] is None else r["doc_id"]]
        assert (r["n_a"], r["n_b"], r["n_links"]) == (len(a), len(b), len(found))
        assert r["n_best"] == sum(held[p] == best[p[0]] for p in found) and r["count_sum"] == sum(held[p] for p in found)
        if groups is not None:
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            assert r["n_groups"] == len(groups) and r["groups_sha256"] == (hashlib.sha256(text.encode()).hexdigest() if groups else "")
    assert alignment.align(frame(spark).limit(0)).count() == 0


def test_division_finds_every_shared_cut():
    """Random ends, sparse and dense, with all shared cuts at one edge too."""
    rng = np.random.default_rng(3)
    for trial in range(400):
        sets, shift = [], 0
        for _ in range(rng.integers(1, 4)):
            size = int(rng.integers(2, 400))
            a, b = (np.flatnonzero(rng.random(size) < rng.random()) for _ in "ab")
            if trial % 3 == 0:
                a, b = a[a % 2 == 0], b[(b % 2 == 1) | (b < 10)]
            sets.append([np.union1d(x, [size]) + shift for x in (a[a > 0], b[b > 0])])
            shift += size
        n_a, n_b = (np.array([len(s[k]) for s in sets]) for k in (0, 1))
        ends_a, ends_b = (np.concatenate([s[k] for s in sets]) for k in (0, 1))
        last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
        group_a, group_b = alignment.cut(ends_a, ends_b, last_a - n_a, last_a, last_b - n_b, last_b)
        shared = np.intersect1d(ends_a, ends_b)
        assert ends_a[np.append(group_a[1:], len(ends_a)) - 1].tolist() == shared.tolist() == ends_b[np.append(group_b[1:], len(ends_b)) - 1].tolist()


def test_encodes_as_the_libraries_do():
    a, _ = alignment.tokenizers(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    rng, letters = np.random.default_rng(7), "abcdeth in's gs.,é日\n<|endoftext|>0123"
    texts = [t for t in TEXTS if t] + ["".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(1, 60))) for _ in range(2000)]
    assert a.encode(texts) == [e.ids for e in A.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_query_over_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in alignment.op13_alignment(spark, folder).collect()}
    docs = {d["doc_id"]: plain(d["text"]) for d in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = Counter(p for *_, found in docs.values() for p in set(found))
    assert len(rows) == len(docs)
    for i, (a, b, _, found) in docs.items():
        assert (rows[i]["n_a"], rows[i]["n_b"], rows[i]["n_links"], rows[i]["count_sum"]) == (len(a), len(b), len(found), sum(held[p] for p in found))
