"""similarity_join() finds every pair of different texts that reaches the threshold, inside large components too."""

import random

import pytest

from starloom.llm import jaccard


def _shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


@pytest.mark.parametrize("hot_level", [jaccard.HOT_LEVEL, 0])
def test_links_are_all_pairs_of_classes(spark, hot_level):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(3000)}" for _ in range(150)] for _ in range(3)]
    texts = []
    for words in base:
        for k in range(14):
            edited = list(words)
            for _ in range(rng.randrange(3)):
                edited[rng.randrange(150)] = f"x{rng.randrange(9)}"
            texts.append(" ".join(edited))
    texts += [texts[0], "alone in the world of words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    joined = jaccard.similarity_join(docs, hot_level=hot_level)
    named = {r["doc_id"]: r["ck"] for r in joined.keyed.collect()}
    sets = {named[i]: _shingles(t) for i, t in enumerate(texts)}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    got = [(r["a"], r["b"]) for r in joined.links.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > len(sets)

    few = jaccard.similarity_join(docs, hot_level=hot_level, spanning=True)
    assert {(r["a"], r["b"]) for r in few.links.collect()} < want
    assert sorted(map(tuple, few.roots.collect())) == sorted(map(tuple, joined.roots.collect()))
