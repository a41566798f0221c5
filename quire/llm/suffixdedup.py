"""Removal of repeated byte strings by a sparse, distributed suffix array.

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else.  Suffixes start at anchors chosen by the text (see
:mod:`quire.llm.suffixes`); every string of ``length`` bytes has one, and
equal strings have equal ones.

1. Texts are landed in blocks with their anchors.  An anchor whose gram occurs
   nowhere else owns no repeated string.  Anchors whose whole surroundings
   (every string they own) are equal form a class: with two members or more,
   all their strings repeat.
2. What is left are the edges of repeats: grams with several classes.  One
   anchor of each class becomes a suffix with its bytes.  Sampled splitters
   range-partition the suffixes by their leading bytes into buckets of bounded
   size; each sorts by multikey quicksort and compares neighbours.  A row's number is the last
   sort key, so suffixes that very many texts share are dealt over many
   buckets.
3. Buckets compare across boundaries.  Equal strings are neighbours up to
   their length, so a run of neighbours that holds neither end of its bucket
   is complete.  The others are sorted once more, by what precedes the anchor.
   Of the strings that are at an end there too, each bucket sends one of a
   kind, as a 128-bit digest, to meet its equals.

Classes are told apart by 128 bits (gram hash and SHA-256), digests of
strings likewise; bytes decide within a bucket.

Defined results: null and empty texts have no bytes; repeated rows are texts
of their own (so a repeated text of ``length`` bytes or more goes whole);
texts shorter than ``length`` keep all bytes; null ids are kept; an empty
table gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import land, ship, table
from quire.llm.suffixes import anchors, compare_bucket, digests
from quire.llm.textwords import PAD, slices, text_bytes

LENGTH = 400
#: Text bytes in a block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: Bytes of suffixes in a bucket, about; sorting takes some ten times that memory.
BUCKET_BYTES = 8 << 20
_CLASS = ["gram", "digest", "lead", "span"]


def text_blocks(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Landed blocks: ids, sizes, compressed texts, and anchors (gram, digest, p1, p2, lead) as arrays."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, pack = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(3)
        for batch in batches:
            for part in slices(batch, limit=BLOCK_BYTES):
                data, off = text_bytes(part.column("text"))
                data = data[: len(data) - PAD]
                grams, at, p1, p2 = anchors(data, off, length, gram)
                own = digests(data, p1, p2 + length)
                ids = part.column("doc_id")
                one = lambda x, t: pa.array([x.astype(t).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                        one(np.diff(off), np.int64),
                        pa.array([pack.compress(data.tobytes())], pa.binary()),
                        one(grams.view(np.int64), np.int64), one(own, np.int64), one(p1, np.int64), one(p2, np.int64), one(at - p1, np.int64),
                    ],
                    ["block", "ids", "sizes", "texts", "gram", "digest", "p1", "p2", "lead"],
                )
                block += 1

    schema = f"block long, ids array<{kind}>, sizes binary, texts binary, gram binary, digest binary, p1 binary, p2 binary, lead binary"
    return land(docs.select("doc_id", "text").mapInArrow(blocks, schema), "text-blocks")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            gram, digest, p1, p2, lead = (np.frombuffer(batch.column(c)[k].as_buffer(), np.int64) for c in ("gram", "digest", "p1", "p2", "lead"))
            cols = [gram, digest, np.full(len(gram), batch.column("block")[k].as_py()), p1, lead.astype(np.int32), (p2 - p1).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["gram", "digest", "block", "p1", "lead", "span"])


def anchor_rows(blocks: DataFrame) -> DataFrame:
    """One row for each anchor: gram, digest, block, p1 (first owned start), lead (its distance), span (starts - 1)."""
    schema = "gram long, digest long, block long, p1 long, lead int, span int"
    return blocks.select("block", "gram", "digest", "p1", "p2", "lead").mapInArrow(_unpacked, schema)


def shared_classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(starts that repeat as whole classes, one anchor of each class of a gram that has several)."""
    own = ("digest", "lead", "span")
    lows, highs = [F.min(c).alias(f"low_{c}") for c in own], [F.max(c).alias(f"high_{c}") for c in own]
    grams = rows.groupBy("gram").agg(F.count("*").alias("n"), *lows, *highs).where("n > 1")
    several = F.expr(" or ".join(f"low_{c} <> high_{c}" for c in own))
    # Landed, so that the join's shuffles are its own and a gram with very many anchors can be split.
    grams = land(grams.select(F.col("gram").alias("g"), several.alias("several")), "grams")
    kept = land(rows.join(grams, rows["gram"] == grams["g"]).drop("g"), "shared-grams")
    edges = kept.where("several")
    classes = edges.groupBy(*_CLASS).agg(F.count("*").alias("n"), F.min(F.struct("block", "p1")).alias("rep"))
    classes = land(classes, "anchor-classes")
    starts = kept.where("not several").select("block", "p1", "span")
    again = edges.join(classes.where("n > 1").select(*_CLASS), _CLASS, "left_semi").select("block", "p1", "span")
    return starts.union(again), classes.select("rep.block", "rep.p1", "lead", "span")


_SUFFIX = "block long, p1 long, lead int, low int, bytes binary"


def suffix_rows(blocks: DataFrame, reps: DataFrame, length: int) -> DataFrame:
    """Suffixes: block, p1, lead, low (largest and smallest distance owned), and the bytes of all owned strings."""
    wanted = reps.groupBy("block").agg(F.collect_list(F.struct("p1", "lead", "span")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                text = unpack.decompress(batch.column("texts")[k].as_buffer())
                want = batch.column("wanted")[k].values
                p1, lead, span = (want.field(c).to_numpy() for c in ("p1", "lead", "span"))
                parts = [text[a : a + s + length] for a, s in zip(p1.tolist(), span.tolist(), strict=True)]
                block = pa.array([batch.column("block")[k].as_py()] * len(parts), pa.int64())
                yield pa.RecordBatch.from_arrays([block, pa.array(p1), pa.array(lead), pa.array(lead - span), pa.array(parts, pa.binary())], ["block", "p1", "lead", "low", "bytes"])

    both = blocks.select("block", "texts").join(wanted, "block").select("block", "texts", "wanted")
    # Landed first: splitters are sampled from the rows.
    return land(both.mapInArrow(cut, _SUFFIX), "suffixes")


def _compared(suffixes: DataFrame, key: Column, length: int, gram: int, by_after: bool) -> DataFrame:
    """One round of buckets, landed: repeated starts (block, p1, span), and what is open.

    Open are suffixes, with the smallest distance that is, if ordered by what
    follows; else starts with digests, a span of 0 if the string is alone in
    its bucket, of -1 if it is known to repeat.
    """

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        del held
        block, p1 = (rows.column(c).to_numpy() for c in ("block", "p1"))
        lead, low = (rows.column(c).to_numpy().astype(np.int64) for c in ("lead", "low"))
        flat, off = text_bytes(rows.column("bytes").cast(pa.large_binary()))
        flags, open_, who, dist = compare_bucket(flat, off[:-1], np.diff(off), lead, low, length, gram, by_after)

        def out(i, first, span=None, suffix=False, digest=None) -> pa.RecordBatch:
            none = lambda t: pa.nulls(len(i), t)
            cols = [pa.array(block[i]), pa.array(first), none(pa.int32()) if span is None else pa.array(span.astype(np.int32))]
            if suffix:
                cols += [pa.array(lead[i].astype(np.int32)), pa.array(open_[i].argmax(axis=1).astype(np.int32)), rows.column("bytes").combine_chunks().cast(pa.large_binary()).take(pa.array(i)).cast(pa.binary())]
            else:
                cols += [none(pa.int32()), none(pa.int32()), none(pa.binary())]
            cols += [none(pa.int64()), none(pa.int64())] if digest is None else [pa.array(digest[:, 0]), pa.array(digest[:, 1])]
            return pa.RecordBatch.from_arrays(cols, ["block", "p1", "span", "lead", "low", "bytes", "f1", "f2"])

        # Runs of repeated distances; the start at distance d is p1 + lead - d.
        runs = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        i, a = np.nonzero(runs == 1)
        _, b = np.nonzero(runs == -1)
        yield out(i, p1[i] + lead[i] - (b - 1), b - 1 - a)
        if by_after:
            i = np.flatnonzero(open_.any(axis=1))
            for s in range(0, len(i), 1 << 12):
                yield out(i[s : s + (1 << 12)], p1[i[s : s + (1 << 12)]], suffix=True)
            return
        view = memoryview(flat)
        for s in range(0, len(who), 1 << 16):
            w, d = who[s : s + (1 << 16)], dist[s : s + (1 << 16)]
            at = off[w] + lead[w] - d
            digest = np.frombuffer(b"".join(hashlib.sha256(view[x : x + length]).digest()[:16] for x in at.tolist()), np.int64).reshape(-1, 2)
            yield out(w, p1[w] + lead[w] - d, np.where(flags[w, d], -1, 0), digest=digest)

    held = suffixes.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    buckets = -(-held // BUCKET_BYTES) or 1
    keyed = suffixes.select("block", "p1", "lead", "low", "bytes", key.alias("key")).repartitionByRange(buckets, "key", F.xxhash64("block", "p1")).drop("key")
    schema = "block long, p1 long, span int, lead int, low int, bytes binary, f1 long, f2 long"
    return land(keyed.mapInArrow(bucket, schema), "suffix-matches")


def compared(suffixes: DataFrame, length: int, gram: int) -> DataFrame:
    """Starts (block, p1, span) that repeat, found in buckets of the range-partitioned suffixes and across them."""
    first = _compared(suffixes, F.expr("substring(bytes, lead + 1)"), length, gram, True)
    # A binary has no reverse: its hex digits, read backwards byte by byte, sort as one.
    backwards = F.expr(f"unhex(array_join(reverse(regexp_extract_all(hex(substring(bytes, 1, lead + {gram})), '..', 0)), ''))")
    second = _compared(first.where("bytes is not null"), backwards, length, gram, False)
    open_ = second.where("f1 is not null").select("block", "p1", "span", "f1", "f2")
    twice = open_.groupBy("f1", "f2").agg(F.count("*").alias("n")).where("n > 1").select("f1", "f2")
    across = open_.where("span = 0").join(twice, ["f1", "f2"], "left_semi")
    out = ["block", "p1", "span"]
    return first.where("bytes is null").select(*out).union(second.where("f1 is null").select(*out)).union(across.select(*out))


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every text and, if asked for, ``kept`` (its remaining bytes)."""
    ship(docs.sparkSession)
    gram = max(1, length // 4)
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = text_blocks(docs, length, gram)
    starts, reps = shared_classes(anchor_rows(blocks))
    starts = starts.union(compared(suffix_rows(blocks, reps, length), length, gram))
    removed = starts.groupBy("block").agg(F.collect_list(F.struct("p1", "span")).alias("removed"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                data = np.frombuffer(unpack.decompress(batch.column("texts")[k].as_buffer()), np.uint8)
                sizes = np.frombuffer(batch.column("sizes")[k].as_buffer(), np.int64)
                off = np.concatenate([[0], np.cumsum(sizes)])
                depth = np.zeros(len(data) + 1, np.int32)
                if batch.column("removed")[k].is_valid:
                    runs = batch.column("removed")[k].values
                    p1, span = runs.field("p1").to_numpy(), runs.field("span").to_numpy()
                    np.add.at(depth, p1, 1)
                    np.add.at(depth, p1 + span + length, -1)
                gone = np.cumsum(depth)[:-1] > 0
                new = gone.copy()  # where a removed run begins
                new[1:] &= ~gone[:-1]
                starts = off[:-1][sizes > 0]
                new[starts] = gone[starts]
                total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[off])  # noqa: B023, E731
                kept = data[~gone].tobytes()
                n_removed = total(gone)
                to = np.concatenate([[0], np.cumsum(sizes - n_removed)]).tolist()
                texts = [kept[a:b] for a, b in zip(to[:-1], to[1:], strict=True)]
                out = [batch.column("ids")[k].values, pa.array(sizes), pa.array(n_removed), pa.array(total(new)), pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string())]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    out, names = [*out, pa.array(texts, pa.binary())], [*names, "kept"]
                yield pa.RecordBatch.from_arrays(out, names)

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    both = blocks.select("block", "ids", "sizes", "texts").join(removed, "block", "left").select("ids", "sizes", "texts", "removed")
    return both.mapInArrow(cut, schema)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
