"""Sorted hash arrays in the shared folder, memory-mapped by workers.

A table maps keys of 64 bits, or of 64 and 32 more (``low``), to a few counts.  Spark deals partial counts out by
the keys' leading bits (uniform, as keys are hashes) and sorts them; each
bucket becomes one file of sorted keys and their summed values.  Workers map
the files and look up sorted queries by binary search, so a model larger than
an executor's memory still serves.
"""

from __future__ import annotations

import functools
import glob
import os
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import staging_path

#: Input bytes behind a bucket, about; sets how many buckets a table gets.
BUCKET_BYTES = 16 << 20
_HEAD = 32  # rows, values, bytes of a value, bytes of ``low`` (0 or 4)


def bucket_bits(input_bytes: int) -> int:
    return max(4, (max(input_bytes, 1) // BUCKET_BYTES).bit_length())


class Bucket(NamedTuple):
    """Sorted keys, their low parts (None: keys have none), and values by rows; views of a bucket's bytes."""

    keys: np.ndarray
    low: np.ndarray | None
    values: np.ndarray

    def find(self, keys: np.ndarray, low: np.ndarray | None) -> np.ndarray:
        """Places of the keys, -1 where a key isn't held."""
        n = len(self.keys)
        at = np.searchsorted(self.keys, keys)
        if self.low is None:
            return np.where((at < n) & (self.keys[np.minimum(at, n - 1)] == keys), at, -1)
        out = np.full(len(keys), -1)
        todo = np.arange(len(keys))
        while len(todo):  # as often as keys share their 64 bits, seldom
            here = at[todo]
            same = (here < n) & (self.keys[np.minimum(here, n - 1)] == keys[todo])
            todo, here = todo[same], here[same]
            hit = self.low[here] == low[todo]
            out[todo[hit]] = here[hit]
            todo = todo[~hit]
            at[todo] += 1
        return out


def encode_bucket(keys: np.ndarray, low: np.ndarray | None, values: np.ndarray) -> bytes:
    wide = values.size and int(values.max()) >> 32
    head = np.array([len(keys), values.shape[1], 8 if wide else 4, 0 if low is None else 4], "<i8").tobytes()
    return head + keys.astype("<u8").tobytes() + (b"" if low is None else low.astype("<u4").tobytes()) + np.ascontiguousarray(values.T).astype("<u8" if wide else "<u4").tobytes()


def decode_bucket(content: np.ndarray) -> Bucket:
    n, k, width, more = (int(x) for x in content[:_HEAD].view("<i8"))
    a, b = _HEAD + 8 * n, _HEAD + (8 + more) * n
    values = content[b : b + width * n * k]
    if values.ctypes.data % width:  # after an odd number of low parts
        values = values.copy()
    return Bucket(content[_HEAD:a].view("<u8"), content[a:b].view("<u4") if more else None, values.view(f"<u{width}").reshape(k, n))


def write_table(partial: DataFrame, values: list[str], bits: int, label: str) -> str:
    """Sum ``values`` by ``key`` (and ``low``, if there is such a column) and store the table; returns its folder."""
    parts = ["key", "low"] if "low" in partial.columns else ["key"]

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        now = -1

        def done() -> pa.RecordBatch:
            *key, vals = (np.concatenate(x) for x in zip(*held, strict=True))
            new = np.any([k[1:] != k[:-1] for k in key], axis=0)
            first = np.flatnonzero(np.concatenate([[True], new]))
            blob = encode_bucket(key[0][first], key[1][first] if len(key) > 1 else None, np.add.reduceat(vals, first, axis=0))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([blob], pa.binary())], ["bucket", "blob"])

        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            low = [batch.column(1).to_numpy().view(np.uint32)] if len(parts) > 1 else []
            vals = np.stack([batch.column(i + len(parts)).to_numpy() for i in range(len(values))], axis=1).astype(np.uint64)
            b = (keys >> np.uint64(64 - bits)).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])).tolist() + [len(b)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if held and b[x] != now:
                    yield done()
                now = int(b[x])
                held.append((keys[x:y], *(k[x:y] for k in low), vals[x:y]))
        if held:
            yield done()

    path = staging_path(partial.sparkSession, label)
    bucket = F.shiftrightunsigned("key", 64 - bits).cast("int")
    rows = partial.select(*parts, *values).repartitionById(1 << bits, bucket).sortWithinPartitions(*parts)  # a task for each bucket
    blobs = rows.mapInArrow(buckets, "bucket long, blob binary")
    blobs.select(F.col("blob").cast("string").alias("value"), "bucket").write.partitionBy("bucket").option("compression", "none").text(path)
    return path


def scan_table(spark: SparkSession, path: str, f: Callable[[Bucket], pa.RecordBatch], schema: str) -> DataFrame:
    """One call of ``f`` for each bucket."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield f(decode_bucket(np.frombuffer(content.as_buffer(), np.uint8)))

    read = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").schema("path string, modificationTime timestamp, length long, content binary").load(f"{path}/*")
    return read.select("content").mapInArrow(rows, schema)


class TableRef:
    """A stored table as tasks find it: by its path where the shared folder is mounted, else from files sent to executors."""

    def __init__(self, spark: SparkSession, path: str, bits: int, values: int):
        url = urlparse(path)
        self.bits, self.values = bits, values
        self.sent = url.scheme not in ("", "file")
        self.root = os.path.basename(path) if self.sent else unquote(url.path)
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{path}/*").inputFiles()
        self.buckets = frozenset(int(unquote(f).split("/bucket=")[1].split("/")[0]) for f in files)
        if self.sent:
            spark.sparkContext.addFile(path, recursive=True)

    def lookup(self, keys: np.ndarray, low: np.ndarray | None = None) -> np.ndarray:
        """Values (one row for each value) of sorted keys; 0 where a key isn't held."""
        out = np.zeros((self.values, len(keys)), np.int64)
        root = SparkFiles.get(self.root) if self.sent else self.root
        b = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])).tolist() + [len(b)] if len(b) else [0]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            if int(b[x]) not in self.buckets:
                continue  # no key of the table begins so
            held = mapped(f"{root}/bucket={b[x]}")
            if held is None:
                raise FileNotFoundError(f"bucket {b[x]} of the table {self.root} can't be read here")
            if len(held.keys):
                at = held.find(keys[x:y], None if low is None else low[x:y])
                out[:, x:y] = np.where(at >= 0, held.values[:, at], 0)
        return out


@functools.lru_cache(maxsize=1 << 14)
def mapped(folder: str) -> Bucket | None:
    files = glob.glob(f"{glob.escape(folder)}/*.txt")
    return decode_bucket(np.memmap(files[0], np.uint8, "r")) if files else None
