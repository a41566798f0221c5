"""Best-fit packing by length-histogram planning.

Only the histogram of piece lengths (at most ``capacity`` rows, whatever the
input) reaches the driver.  Best-fit decreasing runs over counts: bins with
equal room form runs, and one step fills a whole run.  A run whose room is r
keeps less than r / 2 after it is filled, so the plan has at most
O(capacity * log2 capacity) rows.  Pieces then take planned slots by a join
on length and rank within length.

Defined results: null or empty texts are one piece holding the end id alone;
repeated rows are packed each; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import carried, land, ranked, ship, table
from quire.llm.textwords import slices
from quire.llm.wordtokens import encoder

CAPACITY = 2048
#: Text bytes encoded at once.
STEP_BYTES = 1 << 20
#: Ranks within a length are joined in blocks of so many.
BLOCK = 256


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Documents (doc_id, text) as token pieces of at most ``capacity``; only longer documents are cut.

    Returns doc_id, piece, start, length, ids_crc32 and, if asked for, ids.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, limit=STEP_BYTES):
                ids, off = enc.encode(part.column("text"))
                rows, piece, start, size, crc, all_ids = [], [], [], [], [], []
                for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
                    own = np.append(ids[a:b].astype("<u4"), np.uint32(end_id)).astype("<u4")
                    for k, s in enumerate(range(0, len(own), capacity)):
                        cut = own[s : s + capacity]
                        rows.append(i)
                        piece.append(k)
                        start.append(s)
                        size.append(len(cut))
                        crc.append(zlib.crc32(cut.tobytes()))
                        if with_ids:
                            all_ids.append(cut.astype(np.int32))
                out = [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, size, crc))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out, names = [*out, pa.array(all_ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(out, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(pieces, schema)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Returns runs (length, rank_from, rank_to, seq_from, per_seq, offset): the
    pieces of this length with these ranks go, ``per_seq`` to each, to the
    sequences from ``seq_from`` on, from ``offset`` on.
    """
    runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: (first sequence, how many)
    open_rooms, next_seq, out = 0, 0, []

    def put(room: int, first: int, n: int) -> None:
        nonlocal open_rooms
        if n and room:
            runs[room].append((first, n))
            open_rooms |= 1 << room

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            fits = open_rooms >> length
            if fits:
                room = length + (fits & -fits).bit_length() - 1
                first, n = runs[room].pop()
                if not runs[room]:
                    open_rooms &= ~(1 << room)
            else:  # as many new sequences as the rest of this length needs
                room = capacity
                first, n = next_seq, -(-left // (capacity // length))
                next_seq += n
            per = room // length
            whole = min(n, left // per)
            if whole:
                out.append((length, rank, rank + whole * per, first, per, capacity - room))
                put(room - whole // max(whole, 1) * per * length, first, whole)
                rank, left = rank + whole * per, left - whole * per
            if whole < n and left:  # the last few share one sequence
                out.append((length, rank, rank + left, first + whole, left, capacity - room))
                put(room - left * length, first + whole, 1)
                whole, left = whole + 1, 0
            put(room, first + whole, n - whole)
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, key: str = "doc_id") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have a ``length`` of 1 to ``capacity``."""
    spark = pieces.sparkSession
    own = carried(pieces, "length", F.xxhash64(key, "piece").alias("hash"))
    # The hash, and the row number behind it, spread a length that holds a third of all pieces over many ranges.
    placed = ranked(own, ["length", "hash"], "pieces")
    held = placed.groupBy("length", "_part").agg(F.count("*").alias("_n"), F.min("_pos").alias("_low"))
    # One row for each length and range: at most (ranges + capacity) rows in all.
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    held = held.select("length", "_part", (F.col("_base") - F.col("_low")).alias("_shift"))
    counts = {r["length"]: r["n"] for r in placed.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = spark.createDataFrame(plan(counts, capacity), "length long, rank_from long, rank_to long, seq_from long, per_seq long, at long")
    block = lambda c: F.floor(F.col(c) / BLOCK)
    runs = runs.withColumn("block", F.explode(F.sequence(block("rank_from"), F.floor((F.col("rank_to") - 1) / BLOCK))))
    slots = placed.join(held, ["length", "_part"]).withColumn("rank", F.col("_pos") + F.col("_shift")).withColumn("block", block("rank"))
    inside = (slots["length"] == runs["length"]) & (slots["block"] == runs["block"]) & (slots["rank"] >= runs["rank_from"]) & (slots["rank"] < runs["rank_to"])
    nth = F.col("rank") - F.col("rank_from")
    return slots.join(runs, inside).select(
        "doc.*",
        (F.col("seq_from") + F.floor(nth / F.col("per_seq"))).alias("sequence_id"),
        (F.col("at") + nth % F.col("per_seq") * slots["length"]).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their ``ids`` and their place in a sequence."""
    ship(docs.sparkSession)
    # Landed first: range boundaries are sampled from the rows, which must not tokenize every text twice.
    pieces = land(token_pieces(docs, tokenizer, capacity, with_ids=True).withColumn("_row", F.monotonically_increasing_id()), "token-pieces")
    # Places are planned without the ids, which meet them once, by the landed row number.
    return pack(pieces.drop("ids"), capacity).join(pieces.select("_row", "ids"), "_row").drop("_row")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.drop("ids")  # ids_crc32 is their digest
