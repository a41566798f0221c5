"""Target-distribution importance resampling.

Features are runs of 1 to ``most`` words, hashed into buckets.  Counts over
the raw and the target texts give each bucket a gain; a document's weight is
the sum of its features' gains, looked up as arrays, and its score adds Gumbel
noise drawn from its id.  The ``k`` highest scores are drawn by distributed
quickselect: random pivot keys, exact counts between them, and the part that
holds the k-th key goes on.  Only the winners are sorted and ranked.

Hashes are CRC-32; that of a run is put together from those of its words, as
appending n bytes is a linear map on the CRC.

Defined results: null and empty texts have no features and weight 0; a null
id draws the noise of the text ``42:``; ties go to the smaller id, null last,
then to the earlier row; repeated rows are drawn each; an empty table gives
no rows, an empty target makes all gains those of zero counts; extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import land, ship, table
from quire.llm.textwords import Words, per_row, slices
from quire.operators.numbering import dense_number

BUCKETS = 10_000
RUN = 3
MIN_WORDS = 20
PERCENT = 5
#: Words handled at once.
STEP = 1 << 19
#: Pivots of a round; each round leaves about 1 / PIVOTS of the keys.
PIVOTS = 32

#: Bytes outside words: all of ASCII but digits and a-z, after lower-casing A-Z.
OUTSIDE = np.ones(256, dtype=bool)
OUTSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


@functools.lru_cache(maxsize=1)
def _byte_steps() -> np.ndarray:
    """CRC-32 step of each byte value (the reflected polynomial of zlib, from one-byte CRCs)."""
    return np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)


@functools.lru_cache(maxsize=512)
def _shift(n: int) -> np.ndarray:
    """What appending 2^n zero bytes makes of each value of each byte of a CRC (4 x 256)."""
    unit = np.left_shift(np.uint32(1), np.arange(32, dtype=np.uint32))
    if n == 0:
        unit = _byte_steps()[unit & np.uint32(0xFF)] ^ (unit >> np.uint32(8))
    else:
        unit = _apply(_shift(n - 1), _apply(_shift(n - 1), unit))
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    return np.stack([np.bitwise_xor.reduce(np.where(bits == 1, unit[8 * k : 8 * k + 8], np.uint32(0)), axis=1) for k in range(4)])


def _apply(maps: np.ndarray, crc: np.ndarray) -> np.ndarray:
    low = np.uint32(0xFF)
    return maps[0][crc & low] ^ maps[1][(crc >> np.uint32(8)) & low] ^ maps[2][(crc >> np.uint32(16)) & low] ^ maps[3][crc >> np.uint32(24)]


@functools.lru_cache(maxsize=1)
def _short_shifts() -> np.ndarray:
    """The maps for 0 to 31 appended zero bytes (4 x 32 * 256), the bulk of words."""
    maps = np.zeros((32, 4, 256), np.uint32)
    for k in range(4):
        maps[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, 32):
        maps[n] = _apply(_shift(0), maps[n - 1])
    return np.ascontiguousarray(maps.transpose(1, 0, 2)).reshape(4, -1)


def append_zeros(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What each CRC's linear part becomes when n zero bytes follow."""
    maps, at = _short_shifts(), (n & 31).astype(np.int64) << 8
    low = np.uint32(0xFF)
    out = maps[0][at + (crc & low)] ^ maps[1][at + ((crc >> np.uint32(8)) & low)] ^ maps[2][at + ((crc >> np.uint32(16)) & low)] ^ maps[3][at + (crc >> np.uint32(24))]
    left, bit = n >> 5, 5
    while (todo := np.flatnonzero(left)).size:
        odd = todo[(left[todo] & 1) == 1]
        out[odd] = _apply(_shift(bit), out[odd])
        left, bit = left >> 1, bit + 1
    return out


def word_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range."""
    step, low, eight = _byte_steps(), np.uint32(0xFF), np.uint32(8)
    crc, at = np.full(len(start), 0xFFFFFFFF, np.uint32), 0
    size, todo = end - start, np.arange(len(start))
    while len(todo := todo[size[todo] > at]):
        if len(todo) <= 16:  # a few very long words
            for i in todo.tolist():
                crc[i] = zlib.crc32(data[start[i] + at : end[i]].tobytes(), int(crc[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
            break
        c = crc[todo]
        crc[todo] = step[(c ^ data[start[todo] + at]) & low] ^ (c >> eight)
        at += 1
    return crc ^ np.uint32(0xFFFFFFFF)


def run_crcs(crc: np.ndarray, size: np.ndarray, most: int) -> list[np.ndarray]:
    """CRC-32 of the runs of 1 .. ``most`` words that begin at each word, joined by one space.

    The last words of the input begin fewer long runs.
    """
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    after = append_zeros(space, size) ^ crc  # of " " and the word
    out = [crc]
    for k in range(1, most):
        n = max(len(crc) - k, 0)
        out.append(append_zeros(out[-1][:n], size[k:] + 1) ^ after[k:])
    return out


def feature_buckets(words: Words, most: int, buckets: int, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of the features of some rows' words, a bounded number of words at a time."""
    for s in range(0, len(words), step):
        e = min(len(words), s + step + most - 1)  # runs may reach into the next step
        row, size = words.row[s:e], words.end[s:e] - words.start[s:e]
        for k, crc in enumerate(run_crcs(word_crcs(words.data, words.start[s:e], words.end[s:e]), size, most)):
            n = min(len(crc), step)
            whole = row[:n] == row[k : k + n]
            yield (crc[:n][whole] % np.uint32(buckets)).astype(np.int64), row[:n][whole]


def bucket_counts(texts: DataFrame, most: int = RUN, buckets: int = BUCKETS, step: int = STEP) -> np.ndarray:
    """How many features of all texts fall into each bucket: one row a bucket and task reaches the shuffle, one a bucket the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                for bucket, _ in feature_buckets(Words(part.column("text"), lower=True, outside=OUTSIDE), most, buckets, step):
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in found:
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) of each bucket, in doubles."""
    s_all, t_all, n = float(raw.sum()), float(target.sum()), len(raw)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, gains: np.ndarray, most: int = RUN, step: int = STEP) -> DataFrame:
    """Documents (doc_id, text) to row, doc_id, n_words, n_features, weight."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"), lower=True, outside=OUTSIDE)
                n, n_words = part.num_rows, np.diff(words.first)
                weight = np.zeros(n, np.int64)
                for bucket, row in feature_buckets(words, most, len(gains), step):
                    own = np.arange(n + 1) if len(row) == 0 else np.searchsorted(row, np.arange(n + 1))
                    weight += per_row(gains[bucket], own) if len(row) else 0
                n_features = sum(np.maximum(n_words - k, 0) for k in range(most))
                cols = [pa.array(np.arange(at, at + n)), part.column("doc_id"), pa.array(n_words), pa.array(n_features), pa.array(weight)]
                yield pa.RecordBatch.from_arrays(cols, ["row", "doc_id", "n_words", "n_features", "weight"])
                at += n

    return docs.select("doc_id", "text").mapInArrow(weigh, f"row long, doc_id {kind}, n_words long, n_features long, weight long")


def noise(key: str, seed: int = 42) -> Column:
    """floor(1000 * Gumbel noise) of an id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def kth_key(keys: DataFrame, key: Column, k: int, pivots: int = PIVOTS):
    """The k-th smallest (from 1) of keys that all differ, by distributed quickselect.

    Each round takes random pivots among the keys that are left, counts the
    keys below, at and between them, and keeps the part that holds the k-th.
    Only pivots and counts reach the driver.  None if there are fewer keys.
    """
    keys = keys.select(key.alias("key"))
    kind = keys.schema["key"].dataType
    literal = lambda v: F.struct(*(F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(v, kind, strict=True)))
    left, seed = keys, 0
    while True:
        chosen = left.orderBy(F.xxhash64("key", F.lit(seed))).limit(pivots).orderBy("key").collect()
        chosen = [r["key"] for r in chosen]
        if not chosen:
            return None
        below = [F.sum((F.col("key") < literal(p)).cast("long")).alias(f"b{i}") for i, p in enumerate(chosen)]
        counts = list(left.agg(*below).collect()[0])
        at = max((i for i, c in enumerate(counts) if c < k), default=-1)  # the last pivot that isn't past the k-th
        if at >= 0 and counts[at] == k - 1:
            return chosen[at]
        if at >= 0:  # the k-th lies after this pivot
            left, k = left.where(F.col("key") > literal(chosen[at])), k - counts[at] - 1
        if at + 1 < len(chosen):
            left = left.where(F.col("key") < literal(chosen[at + 1]))
        seed += 1


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, most: int = RUN, buckets: int = BUCKETS, seed: int = 42) -> DataFrame:
    """Documents (doc_id, text) to doc_id, n_words, n_features, weight, score, rank (of the drawn; null else)."""
    ship(docs.sparkSession)
    gains = bucket_gains(bucket_counts(docs, most, buckets), bucket_counts(target, most, buckets))
    scored = weights(docs, gains, most).withColumn("score", F.col("weight") + noise("doc_id", seed))
    scored = land(scored, "weights")
    fit = F.col("n_words") >= min_words
    key = F.struct((-F.col("score")).alias("s"), F.col("doc_id").isNull().alias("o"), F.col("doc_id").alias("i"), F.col("row").alias("r"))
    n = scored.where(fit).count() * percent // 100
    none = F.lit(None).cast("long").alias("rank")
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    last = kth_key(scored.where(fit), key, n) if n else None
    if last is None:
        return scored.select(*out, none)
    kind = scored.select(key.alias("k")).schema["k"].dataType
    bound = F.struct(*(F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(last, kind, strict=True)))
    won = fit & (key <= bound)
    winners = scored.where(won).withColumns({"s": -F.col("score"), "o": F.col("doc_id").isNull()})
    winners = dense_number(winners, ["s", "o", "doc_id", "row"], "rank")
    return winners.select(*out, "rank").union(scored.where(~won).select(*out, none))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
