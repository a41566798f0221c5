"""Token-id shards with a minimal-perfect-hash index.

A shard is one file, written by Spark's own writer and commit protocol: the
raw little-endian ids of its documents in key order, each closed by the end
id, then one index record.  The payload has no headers, so a reader may map
it as one id array.  Ids have 2 bytes where the vocabulary allows it, else 4.

The index holds a minimal perfect hash over the shard's keys (levels of
collision-free bits, ranked by popcount), and for each hash slot the key's
fingerprint and record number, and for each record its offset and key.  A
lookup reads a constant number of places: bits, slot, fingerprint, offset.

Beside the shards lies a small table of each one's first and last key (one row
a shard, gathered as shards are written), so a lookup opens only the shards
whose range holds its keys: one a key, more only where rows that share a key
span shards.

Defined results: null and empty texts have the end id alone; rows that share
a key are told apart by their occurrence in the shard; a null key is a key of
its own, first in order; empty tables give no shards' rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark import AccumulatorParam, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import land, ship, table
from quire.llm.textwords import mix, slices
from quire.llm.wordtokens import encoder
from quire.session import staging_path

#: Text bytes of a shard; a shard is read whole by one task.
SHARD_BYTES = 24 << 20
#: Text bytes encoded at once.
STEP_BYTES = 1 << 20
END_ID = 1
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_TRAILER = struct.Struct("<4sHHqqqq")  # magic, id bytes, levels, shard, records, payload bytes, index bytes before this
_MAGIC = b"MPH1"


def key_hashes(keys: np.ndarray, nulls: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    return mix(mix(keys.view(np.uint64) + nulls * _GOLD) ^ mix(occurrence.astype(np.uint64) * _GOLD + np.uint64(1)))


class PerfectHash:
    """Minimal perfect hash: level by level, keys alone on their bit stay there, the rest go on (load 1/2 a level)."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        sizes, parts, level = [], [], 0
        while len(hashes):
            size = 2 * len(hashes) + 1
            at = cls._place(hashes, level, size)
            n = np.bincount(at, minlength=size)
            parts.append(n == 1)
            sizes.append(size)
            hashes, level = hashes[n[at] > 1], level + 1
            if level > 200:
                raise ValueError("two keys share a 64-bit hash")
        return cls(np.array(sizes, np.int64), np.concatenate(parts) if parts else np.zeros(0, bool))

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(hashes + np.uint64((level + 1) * int(_GOLD) % 2**64)) % np.uint64(size)).astype(np.int64)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for some keys that were never added (a fingerprint tells the others)."""
        out = np.full(len(hashes), -1, np.int64)
        todo = np.arange(len(hashes))
        for level, size in enumerate(self.sizes.tolist()):
            at = self.base[level] + self._place(hashes[todo], level, size)
            hit = self.bits[at]
            out[todo[hit]] = self.rank[at[hit]]
            todo = todo[~hit]
        return out


def index_block(shard: int, width: int, keys: np.ndarray, nulls: np.ndarray, counts: np.ndarray) -> bytes:
    """The index record of a shard whose records have these keys and id counts, in order."""
    n = len(keys)
    same = np.zeros(n, bool)
    same[1:] = (keys[1:] == keys[:-1]) & (nulls[1:] == nulls[:-1])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    hashes = key_hashes(keys, nulls, np.arange(n) - first)
    mph = PerfectHash.build(hashes)
    slot = mph.slots(hashes)
    prints, record = np.empty(n, "<u4"), np.empty(n, "<u4")
    prints[slot], record[slot] = (hashes >> np.uint64(32)).astype("<u4"), np.arange(n)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
    body = b"".join([mph.sizes.astype("<i8").tobytes(), np.packbits(mph.bits).tobytes(), prints.tobytes(), record.tobytes(), offsets.tobytes(), keys.astype("<i8").tobytes(), np.packbits(nulls).tobytes()])
    return body + _TRAILER.pack(_MAGIC, width, len(mph.sizes), shard, n, int(offsets[-1]) * width, len(body))


class Shard:
    """One shard's bytes, opened by its index."""

    def __init__(self, content: bytes):
        # The writer closes every record, the index too, with the end id.
        for width in (2, 4):
            magic, w, levels, self.shard, self.n, payload, size = _TRAILER.unpack_from(content, len(content) - width - _TRAILER.size)
            if magic == _MAGIC and w == width:
                break
        else:
            raise ValueError("not a token shard")
        self.ids = np.frombuffer(content, f"<u{width}", payload // width)
        at = len(content) - width - _TRAILER.size - size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(content, kind, n, at)
            at += out.nbytes
            return out

        sizes = take("<i8", levels)
        bits = int(sizes.sum())
        self.mph = PerfectHash(sizes, np.unpackbits(take("u1", -(-bits // 8)), count=bits).astype(bool))
        self.prints, self.record = take("<u4", self.n), take("<u4", self.n)
        self.offsets, self.keys = take("<i8", self.n + 1), take("<i8", self.n)
        self.nulls = np.unpackbits(take("u1", -(-self.n // 8)), count=self.n).astype(bool)

    def find(self, keys: np.ndarray, nulls: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
        """Record numbers of keys, -1 where the shard doesn't hold them."""
        hashes = key_hashes(keys, nulls, occurrence)
        slot = self.mph.slots(hashes)
        held = slot >= 0
        held[held] = self.prints[slot[held]] == (hashes[held] >> np.uint64(32)).astype("<u4")
        out = np.full(len(keys), -1, np.int64)
        out[held] = self.record[slot[held]]
        # The stored key settles what a 32-bit fingerprint leaves open.
        wrong = out >= 0
        wrong[wrong] = (self.keys[out[wrong]] != keys[wrong]) | (self.nulls[out[wrong]] != nulls[wrong])
        out[wrong] = -1
        return out

    def of(self, record: int) -> np.ndarray:
        return self.ids[self.offsets[record] : self.offsets[record + 1]]


class _Ranges(AccumulatorParam):
    """First and last key by shard; a task that ran twice says the same."""

    def zero(self, value: dict) -> dict:
        return {}

    def addInPlace(self, value1: dict, value2: dict) -> dict:  # noqa: N802
        value1.update(value2)
        return value1


def _key_table(path: str) -> str:
    return f"{path.rstrip('/')}-keys"


def write_shards(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> None:
    """Write documents (doc_id integer, text) as shards under ``path``, in ascending doc_id order."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width = np.dtype(enc.width).itemsize
        keys, nulls, counts = [], [], []
        for batch in batches:
            for part in slices(batch, limit=STEP_BYTES):
                ids, off = enc.encode(part.column("text"))
                raw = ids.astype(enc.width).tobytes()
                col = part.column("doc_id")
                nulls.append(np.asarray(col.is_null()))
                keys.append(col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                counts.append(np.diff(off) + 1)
                yield pa.RecordBatch.from_arrays([pa.array([raw[a * width : b * width] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.binary())], ["record"])
        if keys:
            keys, nulls, counts = map(np.concatenate, (keys, nulls, counts))
            shard, held = TaskContext.get().partitionId(), keys[~nulls]
            ranges.add({shard: (bool(nulls.any()), *((int(held[0]), int(held[-1])) if len(held) else (None, None)))})
            block = index_block(shard, width, keys, nulls, counts)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], ["record"])

    spark = docs.sparkSession
    ship(spark)
    ranges = spark.sparkContext.accumulator({}, _Ranges())
    width = np.dtype(encoder(tokenizer).width).itemsize
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // shard_bytes))
    spread = F.xxhash64("text")  # rows that share an id may be many
    rows = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), spread).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), spread)
    # The text writer puts bytes as they are; its line end is the end id.
    line = end_id.to_bytes(width, "little").decode("latin-1")
    if not line.isascii():
        raise ValueError("the end id's bytes must be ASCII")
    rows.mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value")).write.option("lineSep", line).option("compression", "none").text(path)
    # The writer numbers its files as tasks are numbered.
    files = {int(f.rpartition("/part-")[2][:5]): unquote(f) for f in spark.read.format("binaryFile").load(path).inputFiles() if "/part-" in f}
    table_ = [(files[k], *v) for k, v in sorted(ranges.value.items())]
    spark.createDataFrame(table_, "file string, has_null boolean, first long, last long").coalesce(1).write.parquet(_key_table(path))


def _shard_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the shards, each looked up by its key: doc_id, shard, at (ids before it in the shard), n_tokens, ids_crc32."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()  # a worker that wrote shards needs its words no more
        for batch in batches:
            for content in batch.column(0):
                s = Shard(content.as_buffer())
                same = np.zeros(s.n, bool)
                same[1:] = (s.keys[1:] == s.keys[:-1]) & (s.nulls[1:] == s.nulls[:-1])
                first = np.maximum.accumulate(np.where(same, 0, np.arange(s.n)))
                found = s.find(s.keys, s.nulls, np.arange(s.n) - first)
                if (found < 0).any():
                    raise ValueError("a key of the shard isn't found by its index")
                crc = [zlib.crc32(s.of(r).astype("<u4").tobytes()) for r in found.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.keys, pa.int64(), mask=s.nulls), pa.array(np.full(s.n, s.shard)), pa.array(s.offsets[found]), pa.array(s.offsets[found + 1] - s.offsets[found]), pa.array(crc, pa.int64())],
                    ["doc_id", "shard", "at", "n_tokens", "ids_crc32"],
                )

    return _shard_files(spark, path).mapInArrow(rows, "doc_id long, shard long, at long, n_tokens long, ids_crc32 long")


def shards_of(spark: SparkSession, path: str, doc_ids: list[int]) -> list[str]:
    """The files of the shards whose key range holds one of a bounded list of keys."""
    keys = spark.createDataFrame([(int(i),) for i in doc_ids], "key long")
    ranges = spark.read.parquet(_key_table(path))
    met = ranges.join(F.broadcast(keys), (F.col("first") <= F.col("key")) & (F.col("key") <= F.col("last")), "left_semi")
    return [r["file"] for r in met.select("file").collect()]


def fetch(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Token ids of a bounded list of keys: doc_id, ids of its first occurrence; keys not held give no row.

    Only shards whose key range holds one of them are opened.
    """
    want = np.array(sorted(set(doc_ids)), np.int64)
    schema = "doc_id long, ids array<long>"
    files = shards_of(spark, path, want.tolist())
    if not files:
        return spark.createDataFrame([], schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                s = Shard(content.as_buffer())
                found = s.find(want, np.zeros(len(want), bool), np.zeros(len(want), np.int64))
                hit = np.flatnonzero(found >= 0)
                ids = pa.array([s.of(r).astype(np.int64) for r in found[hit].tolist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(want[hit]), pa.array(np.full(len(hit), s.shard)), ids], ["doc_id", "shard", "ids"])

    found = _shard_files(spark, files).mapInArrow(rows, "doc_id long, shard long, ids array<long>")
    first = found.groupBy("doc_id").agg(F.min_by("ids", "shard").alias("ids"))  # rows that share a key may span shards
    return first.select("doc_id", "ids")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = staging_path(spark, "token-shards")
    write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    read = land(read_shards(spark, path), "token-rows")
    # One row for each shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = read.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return read.join(shards, "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
