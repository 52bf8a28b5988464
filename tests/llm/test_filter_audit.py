from itertools import permutations

import pytest

from starloom.llm import filter_audit

WORDS = " ".join(f"w{i}" for i in range(220))
TEXTS = [WORDS, WORDS, "", None, "", "a\tb\x0bc\x0cd  e f", WORDS + " #", "AB" * 3, "same " * 300, WORDS.upper(), "x $ " * 400, WORDS, "日本 " * 250, "A" + "b" * 49, "A" + "b" * 48]


def frame(spark, texts=TEXTS):
    """Nulls in ids and sources, a repeated row, and an extra column that clashes."""
    rows = [(None if i == 11 else i, t, None if i % 4 == 0 else f"s{i % 3}" if i % 5 else "", 1) for i, t in enumerate(texts)]
    return rows + rows[6:7], spark.createDataFrame(rows + rows[6:7] if texts else [], "doc_id long, text string, source string, mask int")


def brute(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    seen = {}
    for i, t, _, _ in rows:
        if i is not None:
            seen[t or ""] = min(i, seen.get(t or "", i))
    docs = []
    for i, t, part, _ in rows:
        t = t or ""
        w = [x for x in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).split(" ") if x]
        first = seen.get(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": first is not None and (i is None or i > first)}
        docs.append((i, part or "", {k for k, v in fails.items() if v}))
    out = {}
    for part in {p for _, p, _ in docs}:
        mine = [(i, f) for i, p, f in docs if p == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                lost = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                failing = [f for _, f in mine if letter in f]
                out[part, "".join(order), step] = [len(left), len(lost), len(failing) - len(lost), sum(f == {letter} for _, f in mine), sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost)]
        for letter in "ABCDE":
            keys = [k for k in out if k[0] == part and k[1][k[2] - 1] == letter]
            total = sum(out[k][1] for k in keys)
            for k in keys:
                out[k].append(total)
    return out


@pytest.mark.parametrize("hot_rows, share", [(10_000, 1000), (1, 1 << 40)])
def test_equals_brute_force(spark, hot_rows, share):
    """With and without texts that count as hot; labels repeat and hold nulls."""
    rows, docs = frame(spark)
    labels = [(0, 1, 0), (1, 1, 0), (1, 0, 1), (6, None, 1), (8, 1, None), (None, 1, 1), (99, 1, 1)]
    found = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), hot_rows, share).collect()
    expected = brute(rows, labels)
    assert len(found) == len(expected) == 600 * len({k[0] for k in expected})
    for r in found:
        assert [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] == expected[r["part"], r["filter_order"], r["step"]]


def test_nothing_and_no_source(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(frame(spark, [])[1], labels).count() == 0
    rows = filter_audit.audit(frame(spark)[1].drop("source"), labels).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {""}


def test_fields_do_not_overflow():
    """The largest count of a field leaves its neighbours alone."""
    most = (1 << 63) - 1
    for mask in range(32):
        one = filter_audit.unpacked(filter_audit.packed(mask))
        assert (filter_audit.unpacked(most * filter_audit.packed(mask)) == one * most).all()
    assert filter_audit.unpacked(filter_audit.packed(0))[:, filter_audit.KEPT].all()
