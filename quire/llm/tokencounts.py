"""Token counts without token ids.

A text's pre-tokens (as byte-level BPE cuts it) are counted for each
document; each distinct pre-token's pieces are counted once, by the library's
model; documents take the counts back and sum them.

Documents are handled in blocks, the texts of one task up to ``BLOCK_BYTES``.
A block has its own list of distinct pre-tokens, and its documents hold
(number in that list, frequency) pairs.  Only the lists are dealt out and
sorted by pre-token, so that each is counted once; the answers return to their
block by a cogroup.  So a pre-token that is in every document is one row for
each block, a block is bounded, and documents move once, as compressed numbers.

Special strings in texts are what the library makes of them: one id each, and
the text on either side is cut on its own.

Defined results: null and empty texts have zero bytes and tokens; repeated
rows and ids are counted each; an empty table gives no rows; extra columns are
ignored, whatever their names.  A block with 2^27 distinct pre-tokens, a task
with 2^16 blocks or 2^20 tasks raise an error.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import ship, table
from quire.llm.textwords import SLICE_BYTES, Words, lanes_hash, mix, per_row, slices
from quire.llm.wordtokens import byte_chars
from quire.session import staging_path

BLOCK_BYTES = 48 << 20
#: Bits of a block's number within its task, and of a pre-token's within its block (fewer than a block has bytes, unless one text is larger).
BLOCK_BITS, NUMBER_BITS = 16, 27
LIMIT = 1024

# Where every character is one of these, the cut below equals the file's Unicode pattern.
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]+")
_PURE = re.compile(f" ?[{_L}]+")
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[0-9]+| ?[^\\s{_L}0-9]+|\\s+(?!\\S)|\\s+")
# White space beyond ASCII's usual six, as bytes: texts with any are cut by the library whole.
_ODD_SPACE = "[\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


class Cutter:
    """Pre-tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.chars = {b: c for b, c in enumerate(byte_chars())}

    def cut(self, text: str) -> list[str]:
        if _PURE.fullmatch(text):
            return [text]
        if _PLAIN.fullmatch(text):
            return _PARTS.findall(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, pretoken: str) -> int:
        return len(self.tok.model.tokenize(pretoken.encode().decode("latin-1").translate(self.chars)))


@functools.lru_cache(maxsize=2)
def cutter(path: str) -> Cutter:
    return Cutter(path)


def units(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges (start, end, row) that pre-tokens never cross: words with one space before them, and runs of white space."""
    n_words = len(w)
    first = np.zeros(n_words, bool)
    first[w.first[:-1][np.diff(w.first) > 0]] = True
    row_start = w.off[w.row]
    gap_from = np.where(first, row_start, np.concatenate([[0], w.end[:-1]]) if n_words else 0)
    gap = w.start - gap_from
    spaced = (gap > 0) & (w.data[np.maximum(w.start - 1, 0)] == 0x20)
    # Of a run before a word, the last character goes to the word if it is a space and stands alone if not.
    lead = np.flatnonzero(gap > 1)
    alone = np.flatnonzero((gap > 0) & ~spaced)
    rows = len(w.off) - 1
    has = np.diff(w.first) > 0
    tail_from = w.off[:-1].copy()
    tail_from[has] = w.end[w.first[1:][has] - 1]
    tail = np.flatnonzero(w.off[1:] > tail_from)
    start = np.concatenate([w.start - spaced, gap_from[lead], w.start[alone] - 1, tail_from[tail]])
    end = np.concatenate([w.end, w.start[lead] - 1, w.start[alone], w.off[1:][tail]])
    return start, end, np.concatenate([w.row, w.row[lead], w.row[alone], np.arange(rows)[tail]])


class Block:
    """Distinct pre-tokens of the texts seen so far, numbered as they came."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.size = 0

    def numbered(self, parts: list[str]) -> list[int]:
        known = self.numbers
        return [known.setdefault(p, len(known)) for p in parts]


def _pack(x: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed."""
    return pa.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _unpack(x: pa.Buffer, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(x, 4 * n, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def count_slice(c: Cutter, block: Block, col: pa.Array) -> tuple[np.ndarray, np.ndarray, bytes]:
    """For each text: special strings in it, how many distinct pre-tokens; and all (pre-token number, frequency) pairs, packed."""
    specials = np.zeros(len(col), np.int64)
    owner = np.arange(len(col))
    odd = pc.fill_null(pc.match_substring_regex(col, _ODD_SPACE), False).to_numpy(zero_copy_only=False)
    hit = odd.copy()
    for s in c.special:
        hit |= pc.fill_null(pc.match_substring(col, s), False).to_numpy(zero_copy_only=False)
    docs: list[np.ndarray] = []
    numbers: list[np.ndarray] = []
    if hit.any():  # these few are cut on their own; the others in one go
        inside = re.compile("|".join(map(re.escape, c.special))) if c.special else None
        for i in np.flatnonzero(hit).tolist():
            text = col[i].as_py()
            pieces = inside.split(text) if inside else [text]
            specials[i] = len(pieces) - 1
            got = [n for p in pieces if p for n in block.numbered([p[a:b] for _, (a, b) in c.tok.pre_tokenizer.pre_tokenize_str(p)])]
            docs.append(np.full(len(got), i))
            numbers.append(np.array(got, np.int64))
        owner = np.flatnonzero(~hit)
        col = col.take(pa.array(owner))
    w = Words(col)
    start, end, row = units(w)
    _, at, inverse = np.unique(mix(lanes_hash(w.data, start, end)), return_index=True, return_inverse=True)
    raw = w.data.tobytes()
    parts = [block.numbered(c.cut(raw[a:b].decode("utf-8", "replace"))) for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    flat = np.fromiter((x for p in parts for x in p), np.int64, int(size.sum()))
    begin = np.concatenate([[0], np.cumsum(size)])
    n = size[inverse]
    to = np.concatenate([[0], np.cumsum(n)])
    docs.append(np.repeat(owner[row], n))
    numbers.append(flat[np.arange(to[-1]) + np.repeat(begin[inverse] - to[:-1], n)])
    doc, number = np.concatenate(docs), np.concatenate(numbers)
    key, times = np.unique(doc << 32 | number, return_counts=True)
    cuts = np.searchsorted(key >> 32, np.arange(len(specials) + 1))
    number = key & 0xFFFFFFFF
    step = np.diff(number, prepend=0)
    step[cuts[:-1][np.diff(cuts) > 0]] = number[cuts[:-1][np.diff(cuts) > 0]]
    return specials, np.diff(cuts), _pack(np.concatenate([step, times]))


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """``key``, n_bytes and n_tokens of every document."""

    columns = ["block", "ids", "n_bytes", "specials", "held", "pairs", "number", "pretoken"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each slice of texts one row; for each block also its list, one row a pre-token."""
        c, part_id, seq = cutter(tokenizer), TaskContext.get().partitionId(), 0
        block = Block()
        kind = pa.null()

        def listed() -> pa.RecordBatch:
            n = len(block.numbers)
            if n >> NUMBER_BITS or seq >> BLOCK_BITS or part_id >> (63 - BLOCK_BITS - NUMBER_BITS):
                raise ValueError(f"a block's place doesn't fit its bits: {n} pre-tokens, block {seq} of task {part_id}")
            none = [pa.nulls(n, t) for t in (pa.list_(kind), *[pa.list_(pa.int64())] * 3, pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, part_id << BLOCK_BITS | seq)), *none, pa.array(np.arange(n)), pa.array(list(block.numbers), pa.string())], columns)

        for batch in batches:
            kind = batch.schema.field(key).type
            for part in slices(batch, "__text", SLICE_BYTES):
                text = part.column("__text")
                size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
                specials, held, pairs = count_slice(c, block, pc.fill_null(text, ""))
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part_id << BLOCK_BITS | seq]), one(part.column(key)), one(size), one(pa.array(specials)), one(pa.array(held)), pa.array([pairs], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string())], columns
                )
                block.size += int(pc.sum(size).as_py() or 0)
                if block.size >= BLOCK_BYTES:
                    yield listed()
                    block, seq = Block(), seq + 1
        if block.numbers:
            yield listed()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by pre-token: its pieces are counted where its run begins."""
        c, last, n = cutter(tokenizer), None, 0
        for batch in batches:
            at = batch.column("at").to_numpy()
            runs = pc.dictionary_encode(batch.column("pretoken"))
            pieces = []
            for x in runs.dictionary.to_pylist():
                n = n if x == last else c.pieces(x)
                last = x
                pieces.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(at >> NUMBER_BITS), pa.array(at & ((1 << NUMBER_BITS) - 1)), pa.array(pieces, pa.int32()).take(runs.indices)], ["of_block", "number", "pieces"])

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        known = np.zeros(right.num_rows, np.int64)
        known[right["number"].to_numpy()] = right["pieces"].to_numpy()
        ids, n_bytes, total = [], [], []
        for row in range(left.num_rows):
            specials, held = (left[x][row].values.to_numpy() for x in ("specials", "held"))
            cuts = np.concatenate([[0], np.cumsum(held)])
            x = _unpack(left["pairs"][row].as_buffer(), 2 * int(cuts[-1]))
            step, times = x[: cuts[-1]], x[cuts[-1] :]
            # Numbers are stored as steps within each document.
            number = np.cumsum(step)
            before = np.concatenate([[0], number])[cuts[:-1]]
            number -= np.repeat(before, held)
            total.append(per_row(known[number] * times, cuts) + specials)
            ids.append(left["ids"][row].values)
            n_bytes.append(left["n_bytes"][row].values)
        if not ids:
            return pa.table({key: pa.array([], left.schema.field("ids").type.value_type), "n_bytes": pa.array([], pa.int64()), "n_tokens": pa.array([], pa.int64())})
        return pa.table({key: pa.concat_arrays(ids), "n_bytes": pa.concat_arrays(n_bytes), "n_tokens": np.concatenate(total)})

    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"block long, ids array<{kind}>, n_bytes array<long>, specials array<long>, held array<long>, pairs binary, number long, pretoken string"
    rows = docs.select(key, F.col("text").alias("__text")).mapInArrow(blocks, schema)
    path = staging_path(docs.sparkSession, "pretokens")
    rows.write.option("compression", "zstd").parquet(path)
    rows = docs.sparkSession.read.schema(rows.schema).parquet(path)
    at = F.shiftleft("block", NUMBER_BITS).bitwiseOR(F.col("number"))
    lists = rows.where("pretoken IS NOT NULL").select("pretoken", at.alias("at"))
    answers = lists.repartition("pretoken").sortWithinPartitions("pretoken").mapInArrow(counted, "of_block long, number long, pieces int")
    texts = rows.where("pairs IS NOT NULL").select("block", "ids", "n_bytes", "specials", "held", "pairs")
    return texts.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(summed, f"`{key}` {kind}, n_bytes long, n_tokens long")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    df = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return df.withColumn("over_limit", F.col("n_tokens") > LIMIT)
