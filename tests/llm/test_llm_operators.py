import hashlib
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from starloom.llm import fingerprints, hnsw, jaccard, language, packing, pieces, quality, secret_scan, tokenfile, tokens, toxicity
from starloom.session import scratch_path

LONG = "word salad with a few more words " * 300
TEXTS = ["", None, "  \n\t ", "one two three", "The stupid idiot said: token = \"abcdef123456\" and left", LONG, LONG, LONG + "end", "AKIA" + "ABCD1234" * 3,
         "deadbeef" * 4, "日本語 テキスト ▁ <|endoftext|> <s>", "x" * 5000, "a  b   c   d", "1 2 3 4 5 6 7 8 9 10 11 12"]


def frame(spark, texts=None):
    """Ids with a null and a repeat, languages with a null, and extra columns that clash with result names."""
    texts = TEXTS if texts is None else texts
    rows = [(None if i == 3 else i, t, None if i % 5 == 0 else "en", "s", len(t or ""), 0.5, 7, "x") for i, t in enumerate(texts)]
    rows += rows[4:5]
    return spark.createDataFrame(rows if texts else [], "doc_id long, text string, lang string, source string, n_chars long, score double, n_tokens long, component_id string")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_trigram_queries():
    assert secret_scan.trigram_query(r"[0-9a-f]+") == ()
    assert secret_scan.trigram_query(r"AKIA[A-Z0-9]+") == ((frozenset({b"aki", b"kia"}),),)
    (clause,) = secret_scan.trigram_query(r"(secret|api_?key)=")
    assert {frozenset({b"api", b"pik", b"ike", b"key", b"ey="})} < set(clause)


def test_secret_scan_equals_brute_force(spark):
    found = {(r["doc_id"], tuple((s["start"], s["kind"], s["end"]) for s in r["found"])) for r in secret_scan.findings(frame(spark)).collect()}
    for i, t in enumerate(TEXTS):
        expected = sorted((a, k, b) for k, r in enumerate(secret_scan.RULES) for a, b in secret_scan.spans_of(t or "", r))
        assert (None if i == 3 else i, tuple((a, secret_scan.RULES[k].kind, b) for a, k, b in expected)) in found
    assert secret_scan.findings(frame(spark, [])).count() == 0
    masked = {r["text"] for r in secret_scan.redact(spark, frame(spark), "").collect()}
    assert 'The stupid idiot said: [secret]" and left' in masked and None in masked and not any("deadbeef" in (t or "") for t in masked)


def test_chunked_encoding_equals_whole():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        whole = Tokenizer.from_file(tokens.tokenizer_path(name))
        whole.encode_special_tokens = True
        cut = tokens.Encoder(tokens.tokenizer_path(name))
        for t in [*TEXTS, " a b", "a b ", "a \n b", "'s 'll a's", "e ́", "İ ſ"]:
            assert np.frombuffer(cut.encode([t or ""])[0], "<u4").tolist() == whole.encode(t or "", add_special_tokens=False).ids


def test_code_is_prefix_free_limited_and_round_trips():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.3, 70_000) - 1, 5000)
    lengths = tokenfile.code_lengths(np.bincount(ids))
    assert lengths.max() <= tokenfile.LONGEST and sum(2.0 ** -int(n) for n in lengths[lengths > 0]) <= 1
    words, tables = tokenfile.code_words(lengths), tokenfile.decode_table(lengths)
    for n in (0, 1, 255, 256, 257, 70_000):
        payload, checkpoints = tokenfile.pack_bits(ids[:n], words, lengths)
        assert (tokenfile.unpack_bits(payload, checkpoints, n, tables) == ids[:n]).all()


def test_token_file(spark):
    path = scratch_path(spark, "tokens")
    tokenfile.write_tokens(frame(spark), path)
    rows = sorted(tokenfile.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    whole = Tokenizer.from_file(tokens.tokenizer_path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    assert rows[0]["doc_id"] is None and [r["doc_id"] for r in rows[1:]] == sorted(r["doc_id"] for r in rows[1:])
    start = 0
    for r in rows:
        assert r["start"] == start and r["ids"] == [*whole.encode(TEXTS[3 if r["doc_id"] is None else r["doc_id"]] or "", add_special_tokens=False).ids, 0]
        start += r["n_tokens"]
    empty = scratch_path(spark, "tokens")
    tokenfile.write_tokens(frame(spark, []), empty)
    assert tokenfile.read_tokens(spark, empty).count() == 0


def test_packing(spark):
    rows = packing.pack(frame(spark)).collect()
    whole = Tokenizer.from_file(tokens.tokenizer_path("word_bpe_49k.json"))
    whole.encode_special_tokens = True
    places = {}
    for r in rows:
        ids = [*whole.encode(TEXTS[3 if r["doc_id"] is None else r["doc_id"]] or "", add_special_tokens=False).ids, 2]
        part = ids[r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids) and len(part) == r["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert packing.pack(frame(spark, [])).count() == 0


def test_best_fill_is_minimal():
    rng = np.random.default_rng(0)
    for _ in range(100):
        counts = {int(k): int(rng.integers(1, 4)) for k in rng.choice(np.arange(3, 60), 5, replace=False)}
        sums = {0}
        for k, n in counts.items():
            sums = {s + j * k for s in sums for j in range(n + 1)}
        taken = packing.best_fill(counts, 97)
        assert sum(k * n for k, n in taken.items()) == max(s for s in sums if s <= 97)
        assert all(n <= counts[k] for k, n in taken.items())


def test_sentencepiece_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=tokens.tokenizer_path("piece_bpe_32k.model"))
    for r in pieces.encode_and_decode(frame(spark)).collect():
        ids = library.encode(TEXTS[3 if r["doc_id"] is None else r["doc_id"]] or "")
        assert r["ids"] == ids and r["decoded"] == library.decode(ids)
    v, rng, letters = pieces.vocabulary(tokens.tokenizer_path("piece_bpe_32k.model")), np.random.default_rng(1), "abcdeth in▁ gs.,é日\n"
    for _ in range(300):
        text = "".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(1, 60)))
        assert v.encode([text])[0].tolist() == library.encode(text)
        assert v.merge_long(text).tolist() == v.merge_words([text])[0].tolist()


def brute_components(texts):
    sets = []
    for t in texts:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    return [len(s) for s in sets], root


def test_jaccard_join_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 400, 60)) for _ in range(3)]
    texts = ["", None, "just three words", "JUST three words", base[0]]
    for k in range(36):  # three groups of near copies, some of them beyond the threshold
        w = base[k % 3].split()
        for p in rng.integers(0, 60, rng.integers(0, 4)):
            w[p] = f"n{rng.integers(0, 9999)}"
        texts.append(" ".join(w))
    texts += texts[6:8]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, root string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.components(docs).collect()}
    sizes, roots = brute_components(texts)
    assert found == {i: (n, c) for i, (n, c) in enumerate(zip(sizes, roots))}
    kept = sorted(r["doc_id"] for r in jaccard.keep_one(spark, docs, "").collect())
    assert kept == sorted(set(roots))


def test_jaccard_join_of_nothing(spark):
    assert jaccard.components(frame(spark, [])).count() == 0


def test_hnsw_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(150, 16))
    data = np.concatenate([centres + rng.normal(size=(150, 16)) * s for s in (0.0, 0.03, 0.08, 0.15)])
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(data)] + [(900, None, "x"), (901, [0.0] * 16, "x"), (902, [float("nan")] * 16, "x"), (None, [1.0] * 16, "x")]
    found = {r["vec_id"]: r for r in hnsw.components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links string")).collect()}
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    true = unit @ unit.T >= 0.95
    np.fill_diagonal(true, False)
    assert sum(found[i]["n_links"] for i in range(600)) >= 0.98 * true.sum()
    assert all(found[i]["n_links"] <= true[i].sum() for i in range(600))
    assert all(found[i]["component_id"] == i and found[i]["kept"] and found[i]["n_links"] == 0 for i in (900, 901, 902))
    assert len(found) == 604


def test_hnsw_over_vectors_of_extreme_size(spark):
    """Squares that overflow or vanish neither lose a link nor make one."""
    rows = [(1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 1e-200]), (4, [1.0, 0.5]), (5, [5e-324, 0.0]), (6, [1.7e308, 1e300]), (7, [1.0, 1.0])]
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in hnsw.components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {1: (3, 1), 2: (3, 1), 3: (3, 1), 7: (3, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5)}


def test_hnsw_over_several_shards(spark, monkeypatch):
    """Partners just above the threshold are found inside shards and between them; self-hits are not counted."""
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 100)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(350, 24))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.951, 0.97, size=(350, 1))
    data = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * side])
    found = {r["vec_id"]: r for r in hnsw.components(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")).collect()}
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    true = unit @ unit.T >= 0.95
    np.fill_diagonal(true, False)
    links = sum(r["n_links"] for r in found.values())
    assert 0.98 * true.sum() <= links <= true.sum()
    assert all(found[i]["n_links"] <= true[i].sum() for i in range(700))


def test_fingerprints(spark):
    docs = frame(spark)
    rows = fingerprints.fingerprints(docs).collect()
    assert len(rows) == len(TEXTS) + 1
    by = {r["doc_id"]: r for r in rows}
    assert by[5]["fingerprint"] == by[6]["fingerprint"] and by[6]["near_next"] == 1.0 and by[0]["fingerprint"] == ""
    ids = [i for i in range(len(TEXTS) - 1, -1, -1) if i != 3]
    order = [*ids, 3]  # the null id comes last
    for k, i in enumerate(order):
        text, after = TEXTS[i] or "", TEXTS[order[(k + 1) % len(order)]] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        r = by[None if i == 3 else i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1


@pytest.mark.parametrize("rows", [(), ((1, 1, 0),), tuple((i, i % 2, int(i == 4)) for i in range(14))])
def test_classifiers_take_any_rows(spark, rows):
    docs = frame(spark)
    for out in (toxicity.scores(docs, labels(spark, rows)), quality.scores(docs, labels(spark, rows))):
        got = out.collect()
        assert len(got) == len(TEXTS) + 1 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.scores(frame(spark, []), labels(spark, rows)).count() == 0


def test_language(spark):
    texts = [("the cat and the dog of the house " if i % 2 else "der hund und die katze von dem haus ") * (i % 7 + 1) for i in range(60)] + [None, "123 !!", ""]
    docs = spark.createDataFrame([(i, t, None if i > 59 else "en" if i % 2 else "de", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, score double")
    for r in language.predictions(docs).collect():
        assert r["lang_pred"] == ("und" if r["doc_id"] > 59 else "en" if r["doc_id"] % 2 else "de")
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert language.predictions(frame(spark, [])).count() == 0


def test_pipeline_stages_keep_columns():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "ngram_jaccard", "secret_scan", "packing"]


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_parity_bits_are_a_lower_bound():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in (0, 1, 2, 40, 400, 2500, 0)]
    sets += [sets[3], np.sort(rng.choice(sets[4], 350, replace=False))]
    marks = jaccard.signatures(np.concatenate(sets), np.array([len(s) for s in sets])).view(np.uint64)
    for a, x in zip(sets, marks, strict=True):
        for b, y in zip(sets, marks, strict=True):
            differing = len(np.setxor1d(a, b))
            bits = int(np.bitwise_count(x ^ y).sum())
            assert bits <= differing and (bits - differing) % 2 == 0
    assert not jaccard.signatures(np.zeros(0, np.uint64), np.array([0, 0])).any()
    assert jaccard.signatures(np.zeros(0, np.uint64), np.zeros(0, np.int64)).shape == (0, jaccard.SIGNATURE)
