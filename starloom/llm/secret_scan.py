"""Secret scan by a trigram inverted index.

Each rule is a regular expression. From its syntax tree comes a Boolean query over the trigrams that any match must contain (letters
folded to lower case): AND over stretches of fixed text, OR over their alternatives. A shard of documents, as large as one vectorised
step, gets postings of the trigrams that queries name; queries intersect and unite postings, and the expression runs on the candidates
alone. A rule without mandatory trigrams scans every document. Shards are slices of Spark's partitions, so nothing is shuffled, a lost
task is repeated from its input, and memory is bounded by the step or one document.

Null text is empty and has no spans. Rows may repeat and ids may be null: each row is scanned by itself. Offsets count code points, ends
are exclusive. Extra columns are ignored by findings() and kept by redact().
"""

from __future__ import annotations

import hashlib
import re
import re._constants as sre
import re._parser as sre_parse
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CACHES, column_texts, lean, reachable, steps, table, utf8


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    #: Least length of the group; shorter matches are dropped after they were found.
    least: int = 0

    def compiled(self) -> re.Pattern:
        return _compiled(self)


@lru_cache(maxsize=256)
def _compiled(rule: Rule) -> re.Pattern:
    return re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.ignore_case else 0))


# Fixed patterns: the three base kinds, then published token formats.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
#: A private key after its BEGIN line: up to the next END line with no other five hyphens before it, or else header and base64 lines, also with
#: escaped line ends. Written without look-ahead, which SQL engines lack; a last short line may take the white space at the text's end with it.
_KEY_BODY = (
    r"(?:(?:-{0,4}[^-])*-----END (?:[A-Z]{1,12} ){0,3}PRIVATE KEY-----"
    r"|(?:(?:[\x20\t-\r]|\\[rn])+(?:(?:Proc-Type|DEK-Info):[^\r\n\\]*|[A-Za-z0-9+/]{16,}={0,2}))*(?:(?:[\x20\t-\r]|\\[rn])+[A-Za-z0-9+/]{1,15}(?:={1,2}|[\x20\t-\r]*$))?)"
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9a-zA-Z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("key_block", r"-----BEGIN (?:[A-Z]{1,12} ){0,3}PRIVATE KEY-----" + _KEY_BODY),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]+:[^\s/:@]+@"),
)
RULES = BASE + MORE

#: A Boolean query: all of the clauses, in each any of the alternatives, in each all of the trigrams. No clause: every document.
Query = tuple[tuple[frozenset[bytes], ...], ...]
_MOST_STRINGS = 64


def _choices(parsed) -> set[str] | None:
    """All strings that a piece of a pattern matches, folded, or None if they are too many."""
    out = {""}
    for op, arg in parsed:
        one = _choice(op, arg)
        if one is None or len(out) * len(one) > _MOST_STRINGS:
            return None
        out = {a + b for a in out for b in one}
    return out


def _choice(op, arg) -> set[str] | None:
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN:
        out: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                out.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < 8:
                out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is sre.SUBPATTERN:
        return _choices(arg[-1])
    if op is sre.BRANCH:
        parts = [_choices(x) for x in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, what = arg
        one = _choices(what)
        if one is None or high is sre.MAXREPEAT or high > 4:
            return None
        out, power = set(), {""}
        for k in range(high + 1):
            if k >= low:
                out |= power
            power = {a + b for a in power for b in one}
            if len(power) > _MOST_STRINGS:
                return None
        return out
    if op is sre.AT:
        return {""}
    return None


def _clauses(parsed) -> list[tuple[frozenset[bytes], ...]]:
    found, run = [], {""}

    def close(strings: set[str]) -> None:
        grams = [frozenset(b[i : i + 3] for i in range(len(b) - 2)) for b in (s.encode() for s in strings)]
        if all(grams):
            found.append(tuple(sorted(set(grams), key=sorted)))

    for op, arg in parsed:
        one = _choice(op, arg)
        if one is not None and len(run) * len(one) <= _MOST_STRINGS:
            run = {a + b for a in run for b in one}
            continue
        close(run)
        run = {""}
        if op is sre.SUBPATTERN:
            found.extend(_clauses(arg[-1]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
            found.extend(_clauses(arg[2]))
        elif one is not None:
            run = one
    close(run)
    return found


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query that every text with a match satisfies; empty if the pattern has no mandatory trigram."""
    return tuple(_clauses(sre_parse.parse(pattern)))


class Index:
    """Postings of the trigrams that a set of queries names, over one shard of texts."""

    def __init__(self, queries: list[Query]):
        grams = sorted({g for q in queries for clause in q for option in clause for g in option})
        self.number = {g: i + 1 for i, g in enumerate(grams)}
        self.slots = np.zeros(1 << 24, np.uint16)
        for g, i in self.number.items():
            self.slots[g[0] << 16 | g[1] << 8 | g[2]] = i
        self.fold = np.array([c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)], dtype=np.uint8)
        self.postings: list[np.ndarray] = []
        self.size = 0

    def load(self, texts: list[str]) -> None:
        raw = [utf8(t) for t in texts]
        data = self.fold[np.frombuffer(b"\0\0".join(raw) + b"\0\0", dtype=np.uint8)].astype(np.int32)
        found = self.slots[data[:-2] << 16 | data[1:-1] << 8 | data[2:]]
        at = np.flatnonzero(found)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 2)
        key = np.unique(found[at].astype(np.int64) * len(raw) + np.searchsorted(ends, at, side="right"))
        cut = np.searchsorted(key, np.arange(1, len(self.number) + 2) * len(raw))
        self.postings = [key[a:b] - (i + 1) * len(raw) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))]
        self.size = len(raw)

    def _all_of(self, grams: frozenset[bytes]) -> np.ndarray:
        lists = sorted((self.postings[self.number[g] - 1] for g in grams), key=len)
        out = lists[0]
        for other in lists[1:]:
            out = np.intersect1d(out, other, assume_unique=True)
        return out

    def candidates(self, query: Query) -> np.ndarray:
        out = np.arange(self.size)
        for clause in query:
            out = np.intersect1d(out, np.unique(np.concatenate([self._all_of(option) for option in clause])), assume_unique=True)
        return out


@lru_cache(maxsize=4)
def _prepared(rules: tuple[Rule, ...]) -> tuple[Index, list[Query]]:
    queries = [trigram_query(r.pattern) for r in rules]
    return Index(queries), queries


CACHES.append(_prepared.cache_clear)


def spans_of(text: str, rule: Rule) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, without those whose group is too short."""
    return [m.span() for m in rule.compiled().finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def shard_spans(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """(start, rule number, end) of every text, in order."""
    index, queries = _prepared(rules)
    index.load(texts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        for i in index.candidates(query):
            found[i] += [(start, k, end) for start, end in spans_of(texts[i], rule)]
    return [sorted(x) for x in found]


def spans_column(spark: SparkSession, rules: tuple[Rule, ...] = RULES):
    """A function text column -> array of (start, kind, end), in code points, by start and then by the order of the rules."""
    reachable(spark)

    @F.pandas_udf("array<struct<start:long,kind:string,end:long>>")
    def spans(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([[{"start": a, "kind": rules[k].kind, "end": b} for a, k, b in x] for held in steps(part) for x in shard_spans(held, rules)], dtype=object)

    return spans


def findings(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, found: array of (start, kind, end) for every row of documents."""
    return documents.select("doc_id", spans_column(documents.sparkSession, rules)("text").alias("found"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("found")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(found, lambda s: s["kind"].isin(*[r.kind for r in BASE]))
    return findings(table(spark, sf_dir, "documents")).select(
        "doc_id", *[number(r.kind) for r in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(found).alias("spans"))


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[secret]") -> str:
    """The text with each stretch of overlapping spans replaced by the mark."""
    out, at, reach = [], 0, 0
    for start, _, end in spans:
        if start >= reach:
            out += [text[at:start], mark]
        reach = at = max(reach, end)
    return "".join(out) + text[at:]


def masked_steps(columns: Iterator[pa.Array], rules: tuple[Rule, ...] = RULES) -> Iterator[pa.Array]:
    """Masked texts, handed on step by step; of a batch, only the texts of a step are strings."""
    for column in columns:
        at = 0
        for held in steps(column_texts(column)):
            null, at = column.slice(at, len(held)).is_null().to_pylist(), at + len(held)
            clean = [redacted(t, x) for t, x in zip(held, shard_spans(held, rules), strict=True)]
            yield pa.array([None if n else new for n, new in zip(null, clean, strict=True)], pa.string())


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Pipeline stage: every document stays; secrets in its text are masked and n_chars follows. Null text stays null."""
    reachable(spark)

    @F.arrow_udf("string")
    @lean
    def masked(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from masked_steps(columns, rules)

    changed = docs.withColumn("text", masked("text"))
    return changed.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else changed


def brute_force(text: str | None, rules: tuple[Rule, ...] = RULES) -> tuple[str, str]:
    """For tests: base digest and joined spans of one text without an index."""
    every = sorted((a, k, b) for k, r in enumerate(rules) for a, b in spans_of(text or "", r))
    base = {r.kind for r in BASE}
    say = lambda keep: ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in every if keep(rules[k].kind))
    return hashlib.sha256(say(base.__contains__).encode()).hexdigest(), say(lambda _: True)
