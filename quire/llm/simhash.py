"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints within ``max_bits`` of each other agree on at least one of
``max_bits`` + 1 blocks of bits.  For each block, a top node holds all
fingerprints that share its masked bit pattern; below it, fingerprints are
sorted by Gray rank, so neighbours share more bits, which leaves and inner
nodes factor out as (shared bits, pattern).  Two nodes whose shared patterns
differ in more than ``max_bits`` places cannot hold a link: whole groups are
pruned on these differences before any fingerprint is compared.

The sorted order of each block is cut into pages of bounded size, so a top
node that holds most fingerprints is many pages; pages that share a top node
meet by a join, and each meeting returns a spanning forest of its links, not
all pairs.  Everything is exact: pigeonhole blocks lose no pair.

Defined results: null, empty and word-free texts have fingerprint zero, linked
like any other; repeated rows share a fingerprint; empty tables give no rows;
extra columns, whatever their names, are kept by ``keep_one`` and ignored
otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import carried, land, ship, table
from quire.llm.components import components, forest
from quire.llm.textwords import Words, slices

WORDS = 4
MAX_BITS = 4
SEED = 42
#: Text bytes fingerprinted at once.
STEP_BYTES = 1 << 20
#: Fingerprints in a page and in a leaf.
PAGE, LEAF = 1024, 32


def shingle_fingerprints(col: pa.Array, words: int, seed: int = SEED) -> np.ndarray:
    """SimHash of each row's lower-cased word shingles (uint64)."""
    w = Words(col, lower=True)
    size = w.end - w.start
    to = np.concatenate([[0], np.cumsum(size + 1)])
    text = w.data[np.minimum(np.arange(to[-1]) + np.repeat(w.start - to[:-1], size + 1), len(w.data) - 1)]
    text[to[1:] - 1] = 0x20
    n = np.diff(w.first)
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    ends = np.concatenate([[0], np.cumsum(count)])
    first = np.arange(ends[-1]) + np.repeat(w.first[:-1] - ends[:-1], count)
    last = first + np.repeat(np.minimum(n, words), count) - 1
    raw, digest = text.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((digest(raw[a:b], seed) for a, b in zip(to[first].tolist(), (to[last + 1] - 1).tolist(), strict=True)), np.uint64, len(first))
    out = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(count)
    step = 1 << 18  # rows of bits unpacked at once
    ones = np.zeros((len(some) + 1, 64), np.int64)
    owner = np.repeat(np.arange(len(some)), count[some])
    for a in range(0, len(h), step):
        bits = np.unpackbits(h[a : a + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[a : a + step]
        at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ones[own[at]] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    major = ones[:-1] * 2 > count[some][:, None]
    out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, words: int = WORDS, keep: str = "doc_id") -> DataFrame:
    """``keep`` and ``fp`` (the fingerprint as a signed long) of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=STEP_BYTES):
                fp = shingle_fingerprints(part.column("text"), words)
                yield pa.RecordBatch.from_arrays([part.column(keep), pa.array(fp.view(np.int64))], [keep, "fp"])

    return docs.select(keep, "text").mapInArrow(rows, f"`{keep}` {docs.schema[keep].dataType.simpleString()}, fp long")


def block_masks(blocks: int) -> list[int]:
    cut = [64 * k // blocks for k in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cut[:-1], cut[1:], strict=True)]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each value in Gray-code order."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def nodes(fps: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes over runs of ``size`` sorted fingerprints: first member, mask of shared bits, shared pattern."""
    at = np.arange(0, len(fps), size)
    mask = ~(np.bitwise_or.reduceat(fps, at) ^ np.bitwise_and.reduceat(fps, at))
    return at, mask, fps[at] & mask


def page_links(a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into a, into b) within ``max_bits``: leaf pairs are pruned on shared patterns, the rest compared."""
    (at_a, mask_a, pat_a), (at_b, mask_b, pat_b) = nodes(a, LEAF), nodes(b, LEAF)
    apart = np.bitwise_count((pat_a[:, None] ^ pat_b[None]) & mask_a[:, None] & mask_b[None])
    la, lb = np.nonzero(apart <= max_bits)
    out_a, out_b = [], []
    inner = np.arange(LEAF)
    for k in range(0, len(la), 512):
        ia, ib = at_a[la[k : k + 512]][:, None] + inner, at_b[lb[k : k + 512]][:, None] + inner
        va, vb = a[np.minimum(ia, len(a) - 1)], b[np.minimum(ib, len(b) - 1)]
        near = (np.bitwise_count(va[:, :, None] ^ vb[:, None, :]) <= max_bits) & (ia < len(a))[:, :, None] & (ib < len(b))[:, None, :]
        p, x, y = np.nonzero(near)
        out_a.append(ia[p, x])
        out_b.append(ib[p, y])
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (np.zeros(0, int), np.zeros(0, int))


def hamming_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct fingerprints (fp: long) to links (a, b) that connect exactly what pairs within ``max_bits`` connect."""
    masks = block_masks(max_bits + 1)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for j, m in enumerate(masks):
                top = fp & np.uint64(m)
                rank = gray_rank(fp & ~np.uint64(m))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), j, np.int32)), pa.array(top.view(np.int64)), pa.array((rank ^ np.uint64(1 << 63)).view(np.int64)), pa.array(fp.view(np.int64))], ["block", "top", "gray", "fp"])

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, held = TaskContext.get().partitionId() << 32, None

        def page(block: int, fp: np.ndarray) -> dict:
            nonlocal seq
            seq += 1
            (_, mask, pattern), m = nodes(fp, len(fp)), masks[block]
            return {"page": seq, "block": block, "low": _signed(int(fp[0]) & m), "high": _signed(int(fp[-1]) & m), "mask": _signed(int(mask[0])), "pattern": _signed(int(pattern[0])), "fps": fp.tobytes()}

        schema = pa.schema([("page", pa.int64()), ("block", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("mask", pa.int64()), ("pattern", pa.int64()), ("fps", pa.binary())])
        for batch in batches:
            block, fp = batch.column("block").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
            if held is not None:
                block, fp = np.concatenate([held[0], block]), np.concatenate([held[1], fp])
            out, a = [], 0
            while a < len(fp):
                b = min(a + PAGE, a + int(np.searchsorted(block[a:], block[a], side="right")))
                if b == len(fp) and b - a < PAGE:
                    break
                out.append(page(int(block[a]), fp[a:b]))
                a = b
            held = (block[a:].copy(), fp[a:].copy()) if a < len(fp) else None
            yield pa.RecordBatch.from_pylist(out, schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([page(int(held[0][0]), held[1])], schema)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                a = np.frombuffer(x.as_buffer(), np.uint64)
                b = a if not y.is_valid else np.frombuffer(y.as_buffer(), np.uint64)
                i, j = page_links(a, b, max_bits)
                both = np.concatenate([a, b]) if b is not a else a
                label = forest(len(both), i, j + (len(a) if b is not a else 0))
                at = np.flatnonzero(label != np.arange(len(both)))
                yield pa.RecordBatch.from_arrays([pa.array(both[at].view(np.int64)), pa.array(both[label[at]].view(np.int64))], ["a", "b"])

    rows = fps.select("fp").mapInArrow(keyed, "block int, top long, gray long, fp long")
    order = ["block", "top", "gray"]
    paged = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pages, "page long, block int, low long, high long, mask long, pattern long, fps binary")
    paged = land(paged, "pages")
    # Only a page's first and last top node can go on in another page.
    ends = paged.withColumn("top", F.explode(F.array_distinct(F.array("low", "high")))).drop("fps")
    left, right = (ends.select("block", "top", *(F.col(c).alias(f"{c}_{s}") for c in ("page", "mask", "pattern"))) for s in "lr")
    apart = F.bit_count((F.col("pattern_l").bitwiseXOR(F.col("pattern_r"))).bitwiseAND(F.col("mask_l")).bitwiseAND(F.col("mask_r")))
    pairs = left.join(right, ["block", "top"]).where((F.col("page_l") < F.col("page_r")) & (apart <= max_bits)).select("page_l", "page_r").distinct()
    one = pairs.join(paged.select(F.col("page").alias("page_l"), F.col("fps").alias("x")), "page_l")
    both = one.join(paged.select(F.col("page").alias("page_r"), F.col("fps").alias("y")), "page_r").select("page_l", "page_r", "x", "y")
    alone = paged.select(F.col("page").alias("page_l"), F.col("page").alias("page_r"), F.col("fps").alias("x"), F.lit(None).cast("binary").alias("y"))
    return alone.union(both).repartition("page_l", "page_r").select("x", "y").mapInArrow(met, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, key: str = "doc_id") -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (smallest key reachable) of every document."""
    ship(docs.sparkSession)
    prints = land(fingerprints(docs, words, key), "fingerprints")
    distinct = land(prints.groupBy("fp").agg(F.min(key).alias("rep")), "distinct")
    label = components(hamming_links(distinct, max_bits))
    of = distinct.join(label, distinct["fp"] == label["node"], "left").select("fp", "rep", F.coalesce("label", "fp").alias("label"))
    of = land(of, "labelled")
    small = of.groupBy("label").agg(F.min("rep").alias("component_id"))
    of = of.join(small, "label").select("fp", "component_id")
    return prints.join(of, "fp").select(key, "fp", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Documents with all their columns, one of each group: its smallest doc_id (one row, if rows repeat)."""
    rows = land(carried(docs).withColumn("row", F.monotonically_increasing_id()), "dedup-input")  # texts are landed once
    key = F.struct(F.col("doc.doc_id").isNull().alias("n"), F.col("doc.doc_id").alias("d"), F.col("row").alias("r"))
    ids = near_duplicates(rows.select(key.alias("key"), F.col("doc.text").alias("text")), words, max_bits, "key")
    kept = ids.where(F.col("key") == F.col("component_id")).select(F.col("key.r").alias("row"))
    return rows.join(kept, "row", "left_semi").select("doc.*")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = near_duplicates(table(spark, sf_dir, "documents"))
    return df.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
