"""Numpy parts of the suffix-array removal: where suffixes start, how a bucket sorts and compares them.

Sorting every byte's suffix would ship hundreds of bytes for each byte of
text.  Instead suffixes start at *anchors* that the text itself chooses: in
the first ``window`` starts of a string of ``length`` bytes, the one whose
next ``gram`` bytes hash lowest (``window + gram - 1 = length``, so a string
holds its anchor's gram whole).  Equal strings choose the same anchor, at the same distance
``d`` from their start, and consecutive strings share one.  An anchor thus
*owns* a run of starts, ``a - d2 .. a - d1``.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np

#: Starts handled at once; the low bits of a packed minimum hold a place in that many.
CHUNK = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte value; powers of an odd base and of its inverse modulo 2^64."""
    values = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64)
    base, n = 0x9E3779B97F4A7C15, CHUNK + 4096
    inverse = pow(base, -1, 1 << 64)
    steps = np.full((2, n), [[base], [inverse]], np.uint64)
    steps[:, 0] = 1
    return values, *np.cumprod(steps, axis=1, dtype=np.uint64)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit rolling hash of every run of ``gram`` bytes (at most CHUNK + 4096 bytes)."""
    values, power, inverse = _powers()
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[data] * power[: len(data)])])
    return _mix((total[gram:] - total[:-gram]) * inverse[: len(data) - gram + 1])


def sliding_min(x: np.ndarray, window: int) -> np.ndarray:
    """Minimum of every ``window`` consecutive values."""
    n = len(x) - window + 1
    blocks = np.concatenate([x, np.full(-len(x) % window, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, window)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[window - 1 : window - 1 + n])


def anchors(data: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of texts lying one after another: gram hash, place, first and last owned start (all absolute)."""
    window = length - gram + 1
    n, out = int(off[-1]), []
    ends = off[1:] - length  # last start of a whole string in each text
    for c in range(0, max(0, n - length + 1), CHUNK):
        stop = min(c + CHUNK, n - length + 1)
        hashes = gram_hashes(data[c : stop + length - 1], gram)
        low = sliding_min((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), window)
        at = (low & _PLACE).astype(np.int64)
        whole = np.zeros(stop - c + 1, np.int32)
        a, b = np.maximum(off[:-1], c), np.minimum(ends + 1, stop)
        some = a < b
        np.add.at(whole, a[some] - c, 1)
        np.add.at(whole, b[some] - c, -1)
        starts = np.flatnonzero(np.cumsum(whole[:-1]))
        if len(starts) == 0:
            continue
        at = at[starts]
        edge = np.flatnonzero((np.diff(at) != 0) | (np.diff(starts) != 1)) + 1
        first, last = np.concatenate([[0], edge]), np.concatenate([edge - 1, [len(starts) - 1]])
        out.append((hashes[at[first]], at[first] + c, starts[first] + c, starts[last] + c))
    if not out:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of the SHA-256 of each byte range."""
    view, sha = memoryview(np.ascontiguousarray(data)), hashlib.sha256
    return np.frombuffer(b"".join(sha(view[a:b]).digest()[:8] for a, b in zip(start.tolist(), end.tolist(), strict=True)), np.int64)


def multikey_quicksort(tokens: np.ndarray) -> np.ndarray:
    """Order of the rows of ``tokens`` (n strings of m tokens each); equal strings keep their order.

    Multikey quicksort with all open segments partitioned in one step: each
    segment splits around a member's token at its own depth into less, equal
    and greater; the equal part goes on with the next token.
    """
    n, m = tokens.shape
    order = np.arange(n)
    place, start, depth = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    while len(place) > 1 and m:
        token = tokens[order[place], depth]
        head = np.flatnonzero(np.concatenate([[True], start[1:] != start[:-1]]))
        size = np.diff(np.concatenate([head, [len(start)]]))
        pivot = np.repeat(token[head + size // 2], size)
        part = (token > pivot).astype(np.int64) - (token < pivot) + 1
        by = np.argsort(np.repeat(np.arange(len(head)), size) * 3 + part, kind="stable")
        order[place], part = order[place[by]], part[by]
        depth = depth + (part == 1)
        new = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (start[1:] != start[:-1])]))
        size = np.diff(np.concatenate([new, [len(part)]]))
        start = np.repeat(place[new], size)
        going = (np.repeat(size, size) > 1) & (depth < m)
        place, start, depth = place[going], start[going], depth[going]
    return order


def as_tokens(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of 8-byte tokens that compare as the bytes do."""
    short = -rows.shape[1] % 8
    padded = np.pad(rows, ((0, 0), (0, short))) if short else np.ascontiguousarray(rows)
    return padded.view(">u8").astype(np.uint64)


def common_prefixes(rows: np.ndarray, step: int = 1 << 12) -> np.ndarray:
    """Equal leading bytes of each row and the one before it (the first: 0)."""
    out = np.zeros(len(rows), np.int64)
    for s in range(1, len(rows), step):
        differ = rows[s : s + step] != rows[s - 1 : s - 1 + len(rows[s : s + step])]
        out[s : s + step] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def compare_bucket(flat: np.ndarray, base: np.ndarray, size: np.ndarray, lead: np.ndarray, low: np.ndarray, length: int, gram: int, by_after: bool):
    """Which strings of a bucket's anchors occur twice in it, and which of them other buckets may hold too.

    Anchor i has the bytes ``flat[base : base + size]``, stands ``lead`` bytes
    in, and is asked for its strings at distance ``d`` = low .. lead.  Two
    strings are equal if their anchors agree on ``length - d`` bytes from the
    anchor on, and on the gram and ``d`` bytes before it, read backwards:
    blocks of either order, cut where neighbours share less than that.
    Buckets are ranges of the order by what follows (``by_after``) or by what
    precedes; a block that holds neither end of its bucket is whole.

    Returns flags (anchor, d) of repeated and of open strings, and one
    (anchor, d) of each open distinct string.
    """
    n, window, step = len(base), length - gram + 1, np.arange(length)
    flags, open_ = np.zeros((n, window), bool), np.zeros((n, window), bool)
    blocks, places = [], []
    for forward in (True, False):
        rows = np.zeros((n, length), np.uint8)
        for s in range(0, n, 1 << 12):
            e = slice(s, min(n, s + (1 << 12)))
            at = lead[e, None] + (step if forward else gram - 1 - step)
            rows[e] = np.where((at >= 0) & (at < size[e, None]), flat[np.clip(base[e, None] + at, 0, len(flat) - 1)], 0)
        order = multikey_quicksort(as_tokens(rows))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        blocks.append(common_prefixes(rows[order]))
        places.append(place)
    who, where = [], []
    for d in range(window):
        own = np.flatnonzero((low <= d) & (d <= lead))
        if len(own) == 0:
            continue
        after, before = np.cumsum(blocks[0] < length - d), np.cumsum(blocks[1] < gram + d)
        own_after, own_before = after[places[0][own]], before[places[1][own]]
        ends, mine = (after, own_after) if by_after else (before, own_before)
        open_[own, d] = (mine == ends[0]) | (mine == ends[-1])
        _, first, inverse, count = np.unique(own_after * (n + 1) + own_before, return_index=True, return_inverse=True, return_counts=True)
        flags[own, d] = count[inverse] > 1
        first = own[first]
        first = first[open_[first, d]]
        who.append(first)
        where.append(np.full(len(first), d))
    return flags, open_, np.concatenate(who or [np.zeros(0, np.int64)]), np.concatenate(where or [np.zeros(0, np.int64)])
