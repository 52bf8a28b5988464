"""Encoding texts with a public tokenizer, one new chunk at a time.

A text is cut before every single space that stands between two characters that are not white space. No token of the two vocabularies
reaches over such a place (their splitting patterns start a new piece at it, and neither lower-casing nor composition crosses a space),
so the ids of a text are those of its chunks in a row. Each worker keeps the ids of the chunks it has met, at most MOST_CHUNKS or as given; chunk borders, look-ups and the ids of whole texts are found with
numpy over a step of texts, and only chunks not met before become strings.
A special token's string in a text (`<|endoftext|>`) is its special id with markers=True, as in the library's plain encode; else ordinary text.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: Chunks whose ids a worker keeps; beyond that it starts anew. About 70 bytes each.
MOST_CHUNKS = 1_500_000
#: Bytes of a chunk that is found by its own bytes, in numbers of eight; longer ones are found in a dict.
WORDS = 3
SHORT = 8 * WORDS
#: A chunk of more bytes is encoded each time and not kept.
LONG_CHUNK = 128

#: New chunks that are encoded as one text; a longer text takes more time for each.
TOGETHER = 200
#: The mask of the bytes that a short chunk of each length has.
_MASKS = ((np.arange(SHORT) < np.arange(SHORT + 1)[:, None]) * np.uint8(255)).view("<u8")
#: Chunks that may stand in a row without a mark: a space, then no white space at either end. Where texts are normalized, only characters
#: that keep their number of bytes in it, which ASCII and U+00C0 to U+00FF (lead byte C3) do when lower-cased and composed.
_WHOLE = re.compile(r"\x20\S(?:.*\S)?", re.S)
_STEADY = re.compile(rb"\x20[!-~\xc3](?:[\t\n\r\x20-~\x80-\xbf\xc3]*[!-~\x80-\xbf])?")
#: A space beside white space, or at the end.
_BESIDE = re.compile(r"\x20(?:\s|\Z|(?<=\s\x20))")
# Odd constants that spread a chunk's numbers over the slots; any would do.
_SPREAD = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


class Kept:
    """Ids of the chunks met, by number; short chunks are looked up many at a time by their bytes.

    An open-addressed table of chunk numbers; a slot is a hit only if all bytes of the chunk are the same.
    """

    def __init__(self) -> None:
        self.slots = np.full(1 << 16, -1, np.int32)
        self.keys = np.zeros((1 << 14, WORDS), np.uint64)
        self.at, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.number = self.used = 0
        self.long: dict[bytes, int] = {}

    def __len__(self) -> int:
        return self.number

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = keys[:, 0] * _SPREAD[0]
        for k in range(1, WORDS):
            h += keys[:, k] * _SPREAD[k]
        h ^= h >> np.uint64(29)
        h *= _SPREAD[1]
        return (h >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each chunk, -1 for unknown ones."""
        slot = self._slot(keys)
        out = self.slots[slot].astype(np.int64)
        left = np.flatnonzero((out >= 0) & ~self._same(out, keys))
        slot = slot[left]
        while len(left):
            slot = slot + 1 & len(self.slots) - 1
            out[left] = chunk = self.slots[slot].astype(np.int64)
            on = np.flatnonzero((chunk >= 0) & ~self._same(chunk, keys[left]))
            left, slot = left[on], slot[on]
        return out

    def _same(self, chunk: np.ndarray, keys: np.ndarray) -> np.ndarray:
        held = self.keys[chunk]
        same = held[:, 0] == keys[:, 0]
        for k in range(1, WORDS):
            same &= held[:, k] == keys[:, k]
        return same

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Keep the ids of new chunks, one after another; the number of the first."""
        first, n = self.number, len(sizes)
        while first + n > len(self.at):
            self.keys = np.concatenate((self.keys, np.zeros_like(self.keys)))
            self.at, self.size = np.concatenate((self.at, np.zeros_like(self.at))), np.concatenate((self.size, np.zeros_like(self.size)))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(ids), len(self.ids) // 2), np.uint32)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.at[first : first + n] = self.used + np.cumsum(sizes) - sizes
        self.size[first : first + n] = sizes
        self.used += len(ids)
        self.number += n
        return first

    def enter(self, keys: np.ndarray, first: int) -> None:
        """Make different, unknown short chunks findable under the numbers from `first`."""
        self.keys[first : first + len(keys)] = keys
        if 2 * self.number > len(self.slots):
            while 2 * self.number > len(self.slots):
                self.slots = np.full(2 * len(self.slots), -1, np.int32)
            known = np.flatnonzero(self.keys[: self.number].any(axis=1))
        else:
            known = np.arange(first, first + len(keys))
        slot = self._slot(self.keys[known])
        while len(known):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = known[free]
            on = self.slots[slot] != known
            known, slot = known[on], slot[on] + 1 & len(self.slots) - 1

    def gather(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks in a row, and how many each has."""
        sizes = self.size[chunks].astype(np.int64)
        ends = np.cumsum(sizes)
        shift = np.repeat(self.at[chunks] - (ends - sizes), sizes)
        return self.ids[shift + np.arange(len(shift))], ends


class Encoder:
    def __init__(self, path: str, most: int = MOST_CHUNKS, markers: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.markers = Tokenizer.from_file(path), most, markers
        added = max(self.tokenizer.get_added_tokens_decoder().items())
        self.mark, self.mark_id = added[1].content, added[0]
        self.known = Kept()
        self.normalized = self.tokenizer.normalizer is not None
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or "</w>"
        # Bytes of text that each id stands for: both vocabularies are written with one character a byte.
        self.bytes = np.array([len((self.tokenizer.id_to_token(i) or "").removesuffix(suffix if self.normalized else "")) for i in range(self.mark_id + 1)], np.int64)

    def _learn(self, chunks: list[bytes]) -> int:
        """Encode new chunks; the number of the first."""
        joined, marked, alone, steady, free = [], [], [], _STEADY.fullmatch, not self.normalized
        for k, c in enumerate(chunks):
            (alone if b"<|" in c else joined if steady(c) or free and _WHOLE.fullmatch(c.decode()) else marked).append(k)
        found = self._joined([chunks[k] for k in joined])
        if found is None:  # a tokenizer that isn't as its form says
            joined, marked, found = [], sorted(joined + marked), (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        found = [found, self._marked([chunks[k] for k in marked]), *((x, [len(x)]) for x in (self._alone(chunks[k].decode()) for k in alone))]
        ids, sizes = np.concatenate([x for x, _ in found]), np.concatenate([n for _, n in found]).astype(np.int64)
        if len(joined) < len(chunks):  # back to the order of the chunks
            order = np.argsort(np.concatenate((joined, marked, alone)).astype(np.int64))
            starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
            ids = ids[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(ids))]
        return self.known.add(ids, sizes)

    def _joined(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of chunks that need no mark between them, and how many each has, told by the bytes that ids stand for; None if they don't add up."""
        if not chunks:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = [b"".join(chunks[i : i + TOGETHER]).decode() for i in range(0, len(chunks), TOGETHER)]
        ids = np.concatenate([np.array(x.ids, dtype=np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.cumsum([len(c.translate(None, b" \t\n\r")) for c in chunks] if self.normalized else [len(c) for c in chunks])
        reached = np.cumsum(self.bytes[ids])
        last = np.searchsorted(reached, ends)
        if last[-1] != len(ids) - 1 or (reached[last] != ends).any():
            return None
        return ids, np.diff(last, prepend=-1)

    def _marked(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks parted by the special token, whose id no ordinary text gives, and how many each has."""
        if not chunks:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.tokenizer.encode_special_tokens = False
        found = np.array(self.tokenizer.encode_batch_fast([self.mark.encode().join(chunks).decode()], add_special_tokens=False)[0].ids, dtype=np.uint32)
        cut = np.flatnonzero(found == self.mark_id)
        return np.delete(found, cut), np.diff(np.append(cut, len(found)), prepend=-1) - 1

    def _alone(self, text: str) -> np.ndarray:
        self.tokenizer.encode_special_tokens = not self.markers
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.known) > self.most or self.known.used > 8 * self.most:
            self.known = Kept()
        data, starts, first = borders(texts)
        sizes = np.diff(starts, append=len(data))
        raw = np.frombuffer(data + bytes(SHORT), np.uint8)
        chunk = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(sizes <= SHORT) if b"\0" not in data else np.zeros(0, np.int64)
        if len(short):
            keys = np.lib.stride_tricks.sliding_window_view(raw, SHORT)[starts[short]].view("<u8")
            keys &= _MASKS[sizes[short]]
            chunk[short] = self.known.find(keys)
            new = np.flatnonzero(chunk[short] < 0)
            if len(new):
                lone, where, which = np.unique(keys[new].view(f"V{SHORT}").ravel(), return_index=True, return_inverse=True)
                at = short[new[where]]
                number = self._learn([data[a : a + n] for a, n in zip(starts[at].tolist(), sizes[at].tolist(), strict=True)])
                self.known.enter(lone.view("<u8").reshape(-1, WORDS), number)
                chunk[short[new]] = number + which.ravel()
        rest = np.flatnonzero(chunk < 0)
        if len(rest):
            long = self.known.long
            parts = [data[a : a + n] for a, n in zip(starts[rest].tolist(), sizes[rest].tolist(), strict=True)]
            if fresh := [c for c in dict.fromkeys(parts) if c not in long]:
                number = self._learn(fresh)
                long.update(zip(fresh, range(number, number + len(fresh))))
            chunk[rest] = [long[c] for c in parts]
            for c in fresh:
                if len(c) > LONG_CHUNK:
                    del long[c]
        ids, ends = self.known.gather(chunk)
        ends = np.concatenate(([0], ends))[first].tolist()
        out = ids.astype("<u4", copy=False).tobytes()
        return [out[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]


def borders(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts in UTF-8 one after another, where their chunks begin, and the number of each text's first chunk (and of all chunks)."""
    encoded = [t.encode() for t in texts]
    data = b"".join(encoded)
    ends = np.cumsum([len(e) for e in encoded], dtype=np.int64) if encoded else np.zeros(0, np.int64)
    begins = np.concatenate(([0], ends))[:-1]
    odd = [k for k, t in enumerate(texts) if _BESIDE.search(t)]
    cut = np.frombuffer(data, np.uint8) == 0x20
    filled = begins[begins < ends]
    cut[filled] = True
    for k in odd:
        cut[begins[k] : ends[k]] = False
        inside = np.cumsum([len(c.encode()) for c in chunks(texts[k])])
        cut[begins[k] + np.concatenate(([0], inside[:-1]))] = True
    starts = np.flatnonzero(cut)
    return data, starts, np.searchsorted(starts, np.append(begins, len(data)))


def chunks(text: str) -> list[str]:
    """The text cut before single spaces between other characters; joined, the chunks are the text."""
    words = text.split(" ")
    out = [words[0]]
    for before, word in zip(words, words[1:]):
        if before and word and not before[-1].isspace() and not word[0].isspace():
            out.append(" " + word)
        else:
            out[-1] += " " + word
    return out


@lru_cache(maxsize=4)
def encoder(path: str, most: int = MOST_CHUNKS, markers: bool = False) -> Encoder:
    return Encoder(path, most, markers)


def tokenizer_path(name: str) -> str:
    """Where this machine keeps a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)
