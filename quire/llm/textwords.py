"""Words of Arrow text columns as numpy offset arrays.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``; as all these
are ASCII, working on UTF-8 bytes equals working on code points.  Null texts
count as empty.  Nothing here keeps more than one slice of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer single text is a slice of its own.
SLICE_BYTES = 4 << 20
#: Zero bytes after the data, so that 8-byte loads near the end stay inside.
PAD = 16

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_C1, _C2, _C3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column (padded with zeros) and its n + 1 offsets."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if col.null_count:
        col = pc.fill_null(col, "")
    if len(col) == 0:
        return np.zeros(PAD, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.concatenate([body, np.zeros(PAD, np.uint8)]), off - off[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of at most ``limit`` text bytes (one row at least)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + limit, side="right")))
        yield batch.slice(a, b - a)
        a = b


def text_beside(batch: pa.RecordBatch, name: str = "__text") -> pa.RecordBatch:
    """A batch of carried documents with their text as a column of its own, which shares the struct's bytes."""
    if name in batch.schema.names:
        return batch
    return pa.RecordBatch.from_arrays([*batch.columns, batch.column("doc").field("text")], [*batch.schema.names, name])


def per_row(values: np.ndarray, row_offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values[row_offsets[i]:row_offsets[i+1]]`` for each i, empty ranges included."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[row_offsets[1:]] - total[row_offsets[:-1]]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def lanes_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, taken in 8-byte lanes."""
    view = np.ndarray((max(len(data) - 7, 0),), dtype="<u8", buffer=data, strides=(1,))
    size = end - start
    h = size.astype(np.uint64) * _C3
    at, todo = 0, np.arange(len(start))
    while len(todo):
        left = size[todo] - at
        lane = view[start[todo] + at] & _KEEP[np.minimum(left, 8)]
        h[todo] = mix(h[todo] * _C3 ^ lane)
        todo, at = todo[left > 8], at + 8
    return h


class Words:
    """The words of a text column: ``start``/``end`` byte offsets, ``row`` of each, ``first`` word of each row (n + 1)."""

    def __init__(self, col: pa.Array | pa.ChunkedArray, lower: bool = False, outside: np.ndarray = _SPACE):
        self.data, self.off = text_bytes(col)
        n = int(self.off[-1])
        if lower:
            up = (self.data >= 0x41) & (self.data <= 0x5A)
            self.data = self.data + (up.astype(np.uint8) << 5)
        word = ~outside[self.data[:n]]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.off] = True
        prev = np.empty(n, dtype=bool)
        prev[:1], prev[1:] = False, word[:-1]
        self.start = np.flatnonzero(word & (~prev | edge[:n]))
        after = np.empty(n, dtype=bool)
        after[-1:], after[:-1] = False, word[1:]
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.off)
        self.row = np.repeat(np.arange(len(self.off) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return lanes_hash(self.data, self.start, self.end)

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first 16 bytes of each word as two numbers, and where these are the whole word (no longer, no zero byte)."""
        view = np.ndarray((len(self.data) - 7,), dtype="<u8", buffer=self.data, strides=(1,))
        size = self.end - self.start
        k1 = view[self.start] & _KEEP[np.minimum(size, 8)]
        k2 = view[np.minimum(self.start + 8, len(view) - 1)] & _KEEP[np.clip(size - 8, 0, 8)]
        whole = size <= 16
        if len(self.data) > PAD and (self.data[:-PAD] == 0).any():
            whole[:] = False
        return k1, k2, whole
