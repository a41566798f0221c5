"""Token ids of whole texts, word by word, as a tokenizers file gives them.

Holds for tokenizers whose pre-tokens never cross ASCII white space and drop
it (``word_bpe_49k.json``): the ids of a text are then those of its words in
order.  Plain words are lower-cased and cut into the file's pre-tokens (runs of
letters, single digits, runs of other signs) in numpy over a whole column, other
words stay whole.  Each distinct piece is encoded by the library's own model once
per worker; pieces are found again by exact key in a numpy table.
"""

from __future__ import annotations

import functools
import re
from array import array

import numpy as np
import pyarrow as pa

from quire.llm.textwords import Words, mix

#: Distinct pieces a worker remembers before it starts afresh (bounds its memory).
CACHE_WORDS = 350_000
#: Longer words aren't cut in numpy, which takes some hundred bytes of memory for each piece.
LONG_WORD = 1 << 12
_SLOTS = 1 << 20
_BLOCK = 1 << 15

# Lower-case Latin letters for which the pattern below equals the file's Unicode pattern.
_L = "a-zß-öø-ÿ"
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[0-9]|[^{_L}0-9]+")

# Bytes of plain words by kind.  The apostrophe begins the pattern's endings, "<" a special token: their words aren't plain.
_LETTER, _DIGIT, _SIGN, _ODD = 1, 2, 3, 4
_KIND = np.full(256, _ODD, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[[0x27, 0x3C]] = _ODD
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x80:0xC0] = _KIND[0xC3] = _LETTER  # U+00C0 to U+00FF, if the lead byte is 0xC3
_KIND[[0x20, *range(0x09, 0x0E)]] = 0


def pieces(w: Words) -> np.ndarray:
    """Make the words of ``w`` pre-tokens: plain words lower-cased and cut, others left whole.  Returns which pieces are such others."""
    n = int(w.off[-1])
    data, kind = w.data, _KIND[w.data[:n]]
    prev = np.concatenate([np.zeros(min(n, 1), np.uint8), data[: max(n - 1, 0)]])
    after = prev == 0xC3
    high = (data[:n] & 0xC0) == 0x80
    odd = (kind == _ODD) | (high & ~after) | (after & ((data[:n] == 0x97) | (data[:n] == 0xB7)))  # the last two: signs among the letters
    upper = ((data[:n] >= 0x41) & (data[:n] <= 0x5A)) | (after & (data[:n] >= 0x80) & (data[:n] <= 0x9E))
    begins = np.zeros(n, bool)
    begins[w.start] = True
    cut = kind == _DIGIT
    cut[1:] |= kind[1:] != kind[:-1]
    cut &= kind != 0
    cut |= begins
    other = w.end - w.start > LONG_WORD
    other[np.searchsorted(w.start, np.flatnonzero(odd), side="right") - 1] = True
    if other.any():
        depth = np.zeros(n + 1, np.int8)
        depth[w.start[other]] += 1
        depth[w.end[other]] -= 1
        inside = np.cumsum(depth[:-1], dtype=np.int8) > 0
        upper &= ~inside
        cut &= ~inside | begins
    w.data = data.copy()
    w.data[:n] += upper.astype(np.uint8) << 5
    start = np.flatnonzero(cut)
    word = np.cumsum(begins[start]) - 1
    end = np.empty_like(start)
    end[:-1] = start[1:]
    last = np.append(word[1:] != word[:-1], np.ones(min(len(word), 1), bool))
    end[last] = w.end[word[last]]
    w.start, w.end, w.first = start, end, np.searchsorted(start, w.off)
    w.row = np.repeat(np.arange(len(w.off) - 1), np.diff(w.first))
    return other[word]


def byte_chars() -> list[str]:
    """The printable character that byte-level BPE writes for each byte (published GPT-2 rule)."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = [chr(b) if b in set(keep) else "" for b in range(256)]
    k = 0
    for b in range(256):
        if not out[b]:
            out[b] = chr(256 + k)
            k += 1
    return out


class WordEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.chars = {b: c for b, c in enumerate(byte_chars())}
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.width = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        self._reset()

    def _reset(self) -> None:
        self.words: dict[bytes, int] = {}  # number of the piece in place and length; plain pieces and other words share no bytes string
        self.place, self.length = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int64)
        self.parts: dict[str, array] = {}
        # The table holds pieces of at most 16 bytes only, so their lengths are small.
        self.t1, self.t2 = np.zeros(_SLOTS, np.uint64), np.zeros(_SLOTS, np.uint64)
        self.toff, self.tlen = np.zeros(_SLOTS, np.int64), np.zeros(_SLOTS, np.int32)
        self.pool = np.zeros(1 << 16, dtype=self.width)
        self.used = 0

    def word_ids(self, word: str) -> list[int]:
        if not _PLAIN.fullmatch(word) or "<" in word and any(s in word for s in self.special):
            return self.tok.encode(word, add_special_tokens=False).ids
        out: list[int] = []
        for part in _PARTS.findall(word.lower()):
            ids = self.parts.get(part)
            if ids is None:
                mapped = part if part.isascii() else part.encode().decode("latin-1").translate(self.chars)
                ids = self.parts[part] = array("I", [t.id for t in self.model.tokenize(mapped)])
            out += ids
        return out

    def _add(self, word: bytes, other: bool) -> int:
        if other:
            ids = self.word_ids(word.decode("utf-8", "replace"))
        else:
            ids = [t.id for t in self.model.tokenize(word.decode() if word.isascii() else word.decode("latin-1").translate(self.chars))]
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(ids), len(self.pool)), self.width)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.words[word] = n = len(self.words)
        if n == len(self.place):
            self.place, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.place, self.length))
        self.place[n], self.length[n] = self.used, len(ids)
        self.used += len(ids)
        return n

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a text column in one array, and the n + 1 offsets of its rows."""
        w = Words(col)
        other = pieces(w)
        if len(self.words) > CACHE_WORDS:
            self._reset()
        k1, k2, whole = w.keys()
        slot = (mix(k1 * np.uint64(0x9E3779B97F4A7C15) ^ k2) & np.uint64(_SLOTS - 1)).astype(np.int64)
        off, size = self.toff[slot], self.tlen[slot].astype(np.int64)
        miss = np.flatnonzero(~((self.t1[slot] == k1) & (self.t2[slot] == k2) & whole))
        if len(miss):
            raw, known, add = w.data.tobytes(), self.words, self._add
            at = np.empty(len(miss), np.int64)
            for low in range(0, len(miss), _BLOCK):  # few Python numbers at once
                some = miss[low : low + _BLOCK]
                for i, (a, b) in enumerate(zip(w.start[some].tolist(), w.end[some].tolist(), strict=True), low):
                    word = raw[a:b]
                    n = known.get(word)
                    at[i] = add(word, other[miss[i]]) if n is None else n
            off[miss], size[miss] = self.place[at], self.length[at]
            keep = whole[miss]
            m, s = miss[keep], slot[miss[keep]]
            # Each slot takes the last word written to it; all four arrays take the same one.
            _, last = np.unique(s[::-1], return_index=True)
            m = m[::-1][last]
            s = slot[m]
            self.t1[s], self.t2[s], self.toff[s], self.tlen[s] = k1[m], k2[m], off[m], size[m]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.arange(ends[-1]) + np.repeat(off - ends[:-1], size)]
        return ids, ends[w.first]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(path)
