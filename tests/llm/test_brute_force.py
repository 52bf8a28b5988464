"""Operators and pipeline stages without SQL against plain Python."""

import struct
import zlib

import numpy as np
import xxhash

from starloom.llm import fingerprints, jaccard, language, quality, secret_scan, toxicity
from test_llm_operators import TEXTS, brute_components, frame, labels

SMALL = "/root/testdata/sf0.001"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


# Fingerprints: one bin at a time.


def chained(values):
    """The 64-bit hash of several values as signed number: the hash of each is the seed of the next."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else struct.pack("<q", v), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_bins(text):
    words = [chained([w.encode()]) for w in text.lower().translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return []
    shingles = [words[i : i + 5] for i in range(len(words) - 4)] or [words]
    least = {}
    for s in shingles:
        h = chained(s)
        b, value = (h >> 56) + 128, h & (1 << 56) - 1
        least[b] = min(value, least.get(b, value))
    out = []
    for i in range(256):
        at = i
        while at not in least:
            at = (at + ((i * 0x9E3779B1 >> 7) % 256 | 1)) % 256
        out.append(least[at] & 15)
    return out


def plain_likeness(a, b):
    if not a or not b:
        return float(a == b)
    equal = sum(x == y for x, y in zip(a, b, strict=True)) / 256
    return max(0.0, (equal - 1 / 16) / (15 / 16))


def test_fingerprints_equal_plain_minhash(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"W{x}" for x in rng.integers(0, 40, n)) for n in (1, 2, 4, 5, 6, 9, 40, 300, 2000)]
    texts += [texts[7].lower(), texts[7] + " tail", "", None, " \t\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    n = len(texts)
    for r in fingerprints.fingerprints(docs).collect():
        text, after = texts[r["doc_id"]] or "", texts[(r["doc_id"] - 1) % n] or ""
        cut = len(text) // 3
        own, edited, other = plain_bins(text), plain_bins(text[: len(text) - cut] + after[:cut]), plain_bins(after)
        assert r["fingerprint"] == "".join(f"{x:x}" for x in own) and r["edited_fingerprint"] == "".join(f"{x:x}" for x in edited)
        assert abs(r["near_edited"] - plain_likeness(own, edited)) < 1e-12 and abs(r["near_next"] - plain_likeness(own, other)) < 1e-12


# Quality: moments by numpy's covariance, densities by determinant and solution.


def test_quality_equals_plain_discriminant(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    marks = spark.read.parquet(f"{SMALL}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    f = dict(zip(texts, quality.statistics([t or "" for t in texts.values()]), strict=True))
    known = {r["doc_id"]: r["quality"] for r in marks.collect() if r["doc_id"] in texts and r["quality"] is not None and not held_out(r["doc_id"])}
    groups = [np.array([f[i] for i, y in known.items() if y == k]) for k in (0, 1)]
    covariances = [np.cov(g.T, bias=True) for g in groups]
    n = [len(g) for g in groups]
    pooled = (n[0] * covariances[0] + n[1] * covariances[1]) / sum(n)

    def density(x, k):
        c = 0.9 * covariances[k] + 0.1 * pooled
        c = 0.99 * c + 0.01 * (np.trace(pooled) / len(x) + 1e-9) * np.eye(len(x))
        d = x - groups[k].mean(axis=0)
        return np.log(n[k]) - 0.5 * (np.linalg.slogdet(c)[1] + d @ np.linalg.solve(c, d))

    rows = quality.scores(docs, marks).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = 1 / (1 + np.exp(-np.clip(density(f[r["doc_id"]], 1) - density(f[r["doc_id"]], 0), -50, 50)))
        assert abs(r["score"] - expected) < 1e-6 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == held_out(r["doc_id"])


def test_statistics_by_counting():
    for text in ("", "a b a b a", "One two TWO two!\nOne two TWO two!\n#1", "x " * 500):
        words = text.lower().split()
        pairs = list(zip(words, words[1:]))
        n, w = len(text), max(len(words), 1)
        shares = [(len(words) - len(set(words))) / w, (len(pairs) - len(set(pairs))) / w, sum(a == b for a, b in pairs) / w]
        lines = text.split("\n")
        shares += [1 - len(set(lines)) / len(lines), sum(c.isupper() for c in text) / max(n, 1), sum(c.islower() for c in text) / max(n, 1)]
        expected = [np.log1p(n), np.log1p(len(words)), np.log1p(n / w), *np.arcsin(np.sqrt(shares))]
        assert np.allclose(quality.statistics(["other words", text, "more"])[1][:9], expected)


# Toxicity: planted texts outside the rows learned from.


def test_planted_toxic_texts_are_caught(spark, tmp_path):
    rng = np.random.default_rng(4)
    plain = [f"word{k}" for k in range(60)]
    rude = ["moron", "pathetic", "trash", "disgusting"]
    rows, marks = [], []
    for i in range(900):
        words = list(rng.choice(plain, 30))
        if i % 4 == 0:
            for p in rng.integers(0, 30, 6):
                words[p] = str(rng.choice(rude))
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels(spark, marks).write.parquet(f"{tmp_path}/labels.parquet")
    found = {r["doc_id"]: r for r in toxicity.scores(docs, labels(spark, marks)).collect()}
    kept = {r["doc_id"] for r in toxicity.keep_clean(spark, docs, str(tmp_path)).collect()}
    assert kept == {i for i, r in found.items() if r["score"] < 0.7}
    asked = [i for i in found if held_out(i)]
    assert np.mean([i not in kept for i in asked if i % 4 == 0]) >= 0.95
    assert np.mean([i in kept for i in asked if i % 4]) >= 0.99


# Pipeline stages, each on its own input.


def test_stage_keeps_known_languages(spark):
    texts = [("the cat and the dog of the house " if i % 2 else "der hund und die katze von dem haus ") * (i % 7 + 1) for i in range(60)] + [None, "123 !!", ""]
    docs = spark.createDataFrame([(i, t, None if i > 59 else "en" if i % 2 else "de") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    sure = {r["doc_id"] for r in language.predictions(docs).collect() if r["lang_pred"] != "und" and r["score"] >= language.LEAST_SCORE}
    kept = [r["doc_id"] for r in language.keep_known(spark, docs, "").collect()]
    assert sorted(kept) == sorted(sure) and set(range(60)) == sure


def test_stage_keeps_one_of_each_group(spark):
    rng = np.random.default_rng(6)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 500, 60)) for _ in range(4)]
    texts = ["", None, "one two", "one two", *[t for b in base for t in (b, b, b + " end", "start " + b)], *[" ".join(b.split()[:30]) for b in base]]
    rows = [(i, t, i * 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id long").repartition(3)
    expected = brute_components([t or "" for t in texts])[1]
    kept = {r["doc_id"] for r in jaccard.keep_one(spark, docs, "").collect()}
    assert kept == {i for i, c in enumerate(expected) if i == c}


def test_rows_without_id_and_repeated_rows_link(spark):
    text = " ".join(f"w{x}" for x in range(40))
    rows = [(None, text), (None, text + " end"), (None, text), (4, text), (4, text), (5, "start " + text), (5, "other words"), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.components(docs).collect()]
    expected = [(None, 36, 4), (None, 37, 4), (None, 36, 4), (4, 36, 4), (4, 36, 4), (5, 37, 4), (5, 1, 5), (None, 1, None)]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert sorted(r["text"] for r in jaccard.keep_one(spark, docs, "").collect()) == sorted([text, "other words", "alone"])


def test_stage_masks_secrets(spark):
    rows = secret_scan.redact(spark, frame(spark), "").collect()
    assert len(rows) == len(TEXTS) + 1
    by = {r["doc_id"]: r["text"] for r in rows}
    assert "abcdef123456" not in by[4] and "stupid idiot" in by[4] and "AKIA" not in by[8] and "deadbeef" not in by[9]
    assert all((by[i] or "") == (TEXTS[i] or "") for i in range(len(TEXTS)) if i not in (3, 4, 8, 9))
