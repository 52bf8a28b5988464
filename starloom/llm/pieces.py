"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Only the vocabulary (pieces, scores, kinds) is read from the model. A text gets its dummy prefix and U+2581 for spaces and is cut into words
before each run of U+2581; where the vocabulary has a piece that reaches over such a place, it is not cut. Words that a worker has not met are
encoded together: their symbols lie in one flat array, the rank of each neighbouring pair beside it. In each round every word finds its least
rank (a segmented minimum) and merges the leftmost pair that has it, all words at once; then the arrays are compacted. A word without a pair is
done. One merge for each word and round keeps the library's order, in which a merge can make a pair that beats the next one in line.
A word of more than LONG symbols goes through the same order with a heap instead, which doesn't grow with the square of its length. Characters
without a piece become byte pieces.

Null and empty text have no ids and decode to the empty text. Rows may repeat, ids may be null; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import ragged
from .common import reachable, steps, table
from .tokens import Kept, tokenizer_path

SPACE = "▁"
LONG = 4096
#: Words whose ids a worker keeps; beyond that, or eight times as many ids, it starts anew.
MOST_WORDS = 400_000
#: Words merged together in one set of rounds hold at most so many characters, or are one word.
ROUND_CHARS = 1 << 18
_NONE = np.int64(1 << 40)
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        number = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(number)]
        pieces = [model.id_to_piece(i) for i in range(number)]
        self.number = number
        self.unknown = model.unk_id()
        self.ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(pieces) if model.is_byte(i)}
        scores = np.array([model.get_score(i) for i in range(number)])
        ranks = np.unique(-scores, return_inverse=True)[1]
        keys, made = [], []
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                left, right = self._symbol(piece[:k]), self._symbol(piece[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    made.append(i)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.made = np.array(made, dtype=np.int64)[order]
        self.ranks = ranks[self.made].astype(np.int64)
        self.pairs = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist(), strict=True), strict=True))
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        out = [b"" if model.is_control(i) else bytes([int(p[3:5], 16)]) if model.is_byte(i) else " ⁇ ".encode() if model.is_unknown(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.out_size = np.fromiter(map(len, out), np.int64, number)
        self.out_at = np.cumsum(self.out_size) - self.out_size
        self.out = np.frombuffer(b"".join(out), np.uint8)
        # "12," and the like in eight bytes, filled up with zero bytes
        self.decimal = np.array([f"{i}," for i in range(number)], "S8").view(np.uint64)
        self.kept = Kept()
        self.known: dict[str, int] = {}

    def _symbol(self, text: str) -> int | None:
        """The number of a piece; a single character without one is numbered after all pieces."""
        found = self.ids.get(text)
        return found if found is not None else self.number + ord(text) if len(text) == 1 else None

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; _NONE where the two don't merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), np.where(hit, self.made[at], 0)

    def merge_words(self, words: list[str]) -> list[np.ndarray]:
        """The symbols of each word after all merges."""
        symbols, sizes = self._merged(words)
        return np.split(symbols, np.cumsum(sizes)[:-1])

    def _merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words in a row after all merges, and how many each word has."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        distinct, code = np.unique(chars, return_inverse=True)
        symbols = np.array([self._symbol(chr(c)) for c in distinct], dtype=np.int64)[code]
        ended, ended_word = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        word = np.repeat(np.arange(len(words)), n)
        ranks, made = np.full(len(symbols), _NONE), np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            ranks[:-1], made[:-1] = self._look_up(symbols[:-1], symbols[1:])
            ranks[:-1][word[1:] != word[:-1]] = _NONE
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(word)])))
            least = np.minimum.reduceat(ranks, starts)
            done = least == _NONE
            if done.any():
                keep = np.repeat(~done, sizes)
                ended.append(symbols[~keep])
                ended_word.append(word[~keep])
                symbols, word, ranks, made = symbols[keep], word[keep], ranks[keep], made[keep]
                least, sizes = least[~done], sizes[~done]
                if not len(symbols):
                    break
            hits = np.flatnonzero(ranks == np.repeat(least, sizes))
            at = hits[np.concatenate(([True], word[hits[1:]] != word[hits[:-1]]))]
            symbols = symbols.copy()
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            ranks, made = ranks.copy(), made.copy()
            ranks[at], made[at] = ranks[at + 1], made[at + 1]  # whether the merged symbol is its word's last
            at = at - np.arange(len(at))
            symbols, word, ranks, made = symbols[keep], word[keep], ranks[keep], made[keep]
            renewed = np.concatenate((at, at - 1))
            renewed = renewed[(renewed >= 0) & (renewed + 1 < len(symbols))]
            renewed = renewed[word[renewed] == word[renewed + 1]]
            ranks[renewed], made[renewed] = self._look_up(symbols[renewed], symbols[renewed + 1])
            last = at[(at + 1 >= len(symbols)) | (word[np.minimum(at + 1, len(symbols) - 1)] != word[at])]
            ranks[last] = _NONE
        word = np.concatenate(ended_word)
        return np.concatenate(ended)[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def merge_long(self, word: str) -> np.ndarray:
        """The symbols of one very long word: the same order of merges from a heap."""
        symbols = [self._symbol(c) for c in word]
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (found := self.pairs.get(symbols[i] << 32 | symbols[j])):
                heapq.heappush(heap, (found[0], i, j, symbols[i], symbols[j]))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, left, right = heapq.heappop(heap)
            if symbols[i] != left or symbols[j] != right or after[i] != j:
                continue
            symbols[i], symbols[j] = self.pairs[left << 32 | right][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return np.array([s for s in symbols if s >= 0], dtype=np.int64)

    def _ids(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words given by their symbols, and how many each word has: characters without a piece become byte pieces."""
        odd = np.flatnonzero(symbols >= self.number)
        if len(odd):
            distinct, code = np.unique(symbols[odd], return_inverse=True)
            if self.byte_ids:
                made = [[self.byte_ids[b] for b in chr(s - self.number).encode("utf-8", "surrogatepass")] for s in distinct.tolist()]
            else:
                made = [[self.unknown]] * len(distinct)
            n = np.fromiter(map(len, made), np.int64, len(made))
            times = np.ones(len(symbols), np.int64)
            times[odd] = n[code]
            at = np.cumsum(times) - times
            symbols = np.repeat(symbols, times)
            symbols[ragged(at[odd], times[odd])] = np.concatenate(made)[ragged((np.cumsum(n) - n)[code], times[odd])]
            total = np.concatenate(([0], np.cumsum(times)))
            ends = np.cumsum(sizes)
            sizes = total[ends] - total[ends - sizes]
        return symbols, sizes

    def _keep(self, words: list[str], symbols: np.ndarray, sizes: np.ndarray) -> None:
        first = self.kept.add(*self._ids(symbols, sizes))
        self.known.update(zip(words, range(first, first + len(words)), strict=True))

    def _learn(self, words: list[str]) -> None:
        held, size = [], 0
        for w in sorted(words, key=len):
            if len(w) > LONG:
                symbols = self.merge_long(w)
                self._keep([w], symbols, np.array([len(symbols)]))
                continue
            if held and size + len(w) > ROUND_CHARS:
                self._keep(held, *self._merged(held))
                held, size = [], 0
            held.append(w)
            size += len(w)
        if held:
            self._keep(held, *self._merged(held))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        ids, ends = self.encode_all(texts)
        return np.split(ids, ends[:-1]) if len(ends) else []

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's end."""
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        parts = [_WORD.findall(t) for t in marked] if self.cuts else [[t] if t else [] for t in marked]
        if len(self.known) > MOST_WORDS or self.kept.used > 8 * MOST_WORDS:
            self.known, self.kept = {}, Kept()
        words = list(chain.from_iterable(parts))
        number = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(number < 0)
        if len(unknown):
            fresh = [words[i] for i in unknown.tolist()]
            new = list(dict.fromkeys(fresh))
            self._learn(new)
            number[unknown] = np.fromiter(map(self.known.__getitem__, fresh), np.int64, len(fresh))
            for w in new:
                if len(w) > 64:
                    del self.known[w]
        ids, ends = self.kept.gather(number)
        last = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        return ids, np.concatenate(([0], ends))[last]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces in a row without the dummy prefix; bytes that aren't UTF-8 become U+FFFD."""
        return self.decode_all([ids])[0]

    def decode_all(self, ids_of: list[np.ndarray]) -> list[str]:
        """The texts of several lists of ids."""
        ids = np.concatenate([np.zeros(0, np.int64), *ids_of]).astype(np.int64)
        raw = self.out[ragged(self.out_at[ids], self.out_size[ids])].tobytes()
        sizes = np.concatenate(([0], np.cumsum(self.out_size[ids])))
        ends = sizes[np.cumsum([0, *map(len, ids_of)])].tolist()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
        return [t[1:] if t[:1] == " " else t for t in texts]

    def said(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        return self.decimal[ids].tobytes().translate(None, b"\0")[:-1]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_and_decode(documents: DataFrame, model: str | None = None, digests: bool = False) -> DataFrame:
    """doc_id and, per document, ids (array<int>) and decoded, or with digests n_tokens, ids_sha256 and decoded_sha256."""
    reachable(documents.sparkSession)
    path = model or tokenizer_path("piece_bpe_32k.model")
    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"

    @F.pandas_udf(kind)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v = vocabulary(path)
        for part in parts:
            rows = []
            for held in steps(part):
                ids_of = v.encode(held)
                for ids, text in zip(ids_of, v.decode_all(ids_of), strict=True):
                    if digests:
                        rows.append((len(ids), hashlib.sha256(v.said(ids)).hexdigest(), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()))
                    else:
                        rows.append((ids.astype(np.int32), text))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in kind.split(", ")])

    return documents.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(table(spark, sf_dir, "documents"), digests=True)
