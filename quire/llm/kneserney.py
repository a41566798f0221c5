"""Interpolated modified Kneser-Ney model of word bigrams.

Bigram counts, word counts, contexts and continuation counts are summed by
Spark and stored as sorted hash arrays (``hashtables``), which workers
memory-map to score texts.  Words are 64-bit hashes in the word table (the
base score is exact); in bigrams each word has 48 bits, so a share of about
V / 2**48 of V distinct words meets another one there (4 in a million at 10^9).

A bigram's key starts with four bits of its second word, so the rows of one
context, however many, spread over 16 buckets at least; partial counts are
summed for each slice of text before they are shuffled.

Defined results: null or empty texts are the end token alone; without any
training text every word has probability 1; repeated rows count and are
scored each; empty tables give no rows; extra columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import crc_mod, ship, table
from quire.llm.hashtables import Bucket, TableRef, bucket_bits, scan_table, write_table
from quire.llm.textwords import Words, mix, per_row, slices

END, START = (mix(np.array([x], np.uint64))[0] for x in (0xE0D, 0xB05))
#: Text bytes counted together before the shuffle.
COUNT_BYTES = 12 << 20
_16, _32 = np.uint64(16), np.uint64(32)


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each row's words and end, the hashes before each of them, and the n + 1 row offsets."""
    w = Words(col, lower=True)
    off = w.first + np.arange(len(w.first))
    out = np.empty(off[-1], np.uint64)
    out[off[1:] - 1] = END
    inner = np.ones(len(out), bool)
    inner[off[1:] - 1] = False
    out[inner] = mix(w.hashes())
    prev = np.empty_like(out)
    prev[1:] = out[:-1]
    prev[off[:-1]] = START
    return out, prev, off


def bigram_keys(prev: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four bits of the word, 48 of the context, 12 of the word; and 32 more of the word."""
    c, w = prev >> _16, word >> _16
    high = (w >> np.uint64(44)) << np.uint64(60) | c << np.uint64(12) | (w >> _32) & np.uint64((1 << 12) - 1)
    return high, (w & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def bigram_parts(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context and word of bigram keys, in the leading 48 bits of each."""
    c = high >> np.uint64(12) & np.uint64((1 << 48) - 1)
    w = (high >> np.uint64(60)) << np.uint64(44) | (high & np.uint64((1 << 12) - 1)) << _32 | low
    return c << _16, w << _16


def short(words: np.ndarray) -> np.ndarray:
    """Words as bigrams know them."""
    return (words >> _16) << _16


def _counted(*keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys, sorted, and how often each occurs."""
    if len(keys) == 1:
        keys = [np.sort(keys[0])]
    else:
        order = np.argsort(keys[0], kind="stable")
        keys = [k[order] for k in keys]
        tied = np.flatnonzero(keys[0][1:] == keys[0][:-1])
        if len(tied):  # runs that share the first part are few: order them by the second
            at = np.unique(np.concatenate([tied, tied + 1]))
            by = at[np.lexsort([k[at] for k in keys[::-1]])]
            for k in keys:
                k[at] = k[by]
    new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    first = np.flatnonzero(np.concatenate([[True], new])) if len(keys[0]) else np.zeros(0, int)
    return [k[first] for k in keys], np.diff(np.append(first, len(keys[0])))


def _counts(docs: DataFrame, pairs: bool) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def counted() -> pa.RecordBatch:
            keys, n = _counted(*map(np.concatenate, zip(*held, strict=True)))
            held.clear()
            cols = [pa.array(keys[0].view(np.int64)), *(pa.array(k.view(np.int32)) for k in keys[1:]), pa.array(n.astype(np.int64))]
            return pa.RecordBatch.from_arrays(cols, ["key", "low", "n"] if pairs else ["key", "n"])

        for batch in batches:
            for part in slices(batch):
                word, prev, _ = tokens(part.column(0))
                held.append(bigram_keys(prev, word) if pairs else (word,))
                size += pc.sum(pc.binary_length(part.column(0))).as_py() or 0
                if size >= COUNT_BYTES:
                    yield counted()
                    size = 0
        if held:
            yield counted()

    return docs.select("text").mapInArrow(rows, "key long, low int, n long" if pairs else "key long, n long")


class Discounts(NamedTuple):
    """Modified Kneser-Ney discounts for counts 1, 2, 3 and more."""

    one: float
    two: float
    more: float

    @classmethod
    def of(cls, n: list[int]) -> Discounts:
        """From how many counts are 1, 2, 3, 4; 0.5 for each where these are too few to tell."""
        if not all(n[:3]):
            return cls(0.5, 0.5, 0.5)
        y = n[0] / (n[0] + 2 * n[1])
        d = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
        return cls(*(min(max(x, 0.01), k + 0.99) for k, x in enumerate(d)))

    def __call__(self, c: np.ndarray) -> np.ndarray:
        return np.select([c == 0, c == 1, c == 2], [0.0, self.one, self.two], self.more)


def _count_stats(spark: SparkSession, path: str) -> tuple[int, int, list[int], int]:
    """Keys, sum, how many counts are 1 to 4, how many 3 or more: one row for each bucket, summed."""

    def f(held: Bucket) -> pa.RecordBatch:
        c = held.values[0]
        got = [len(c), int(c.sum(dtype=np.int64)), *(int((c == k).sum()) for k in (1, 2, 3, 4)), int((c >= 3).sum())]
        return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in got], list("abcdefg"))

    r = scan_table(spark, path, f, ", ".join(f"{c} long" for c in "abcdefg")).agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in "abcdefg")).first()
    return r[0], r[1], list(r[2:6]), r[6]


class Model(NamedTuple):
    words: TableRef  # word -> count
    pairs: TableRef  # bigram -> count
    contexts: TableRef  # context -> its count; how many words follow it once, twice, more
    follows: TableRef  # word -> contexts it follows
    n_tokens: int
    n_words: int
    n_types: int  # distinct bigrams
    pair_discounts: Discounts
    word_discounts: Discounts
    floor: float  # weight of the uniform distribution


def train(docs: DataFrame) -> Model:
    """Learn from the texts of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    bits = bucket_bits(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    words = write_table(_counts(docs, pairs=False), ["n"], bits, "lm-words")
    pairs = write_table(_counts(docs, pairs=True), ["n"], bits, "lm-pairs")

    def contexts(held: Bucket) -> pa.RecordBatch:
        c, n = bigram_parts(held.keys, held.low)[0], held.values[0].astype(np.int64)  # sorted: a bucket has one start of the word
        at = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        sums = [np.add.reduceat(x.astype(np.int64), at) for x in (n, n == 1, n == 2, n >= 3)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (c[at].view(np.int64), *sums)], ["key", "n", "n1", "n2", "n3"])

    def follows(held: Bucket) -> pa.RecordBatch:
        (w,), n = _counted(bigram_parts(held.keys, held.low)[1])
        return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

    small = max(4, bits - 2)
    ctx = write_table(scan_table(spark, pairs, contexts, "key long, n long, n1 long, n2 long, n3 long"), ["n", "n1", "n2", "n3"], small, "lm-contexts")
    fol = write_table(scan_table(spark, pairs, follows, "key long, n long"), ["n"], small, "lm-follows")
    n_words, n_tokens, _, _ = _count_stats(spark, words)
    n_types, _, pair_n, _ = _count_stats(spark, pairs)
    _, _, word_n, more = _count_stats(spark, fol)
    dp, dw = Discounts.of(pair_n), Discounts.of(word_n)
    floor = (dw.one * word_n[0] + dw.two * word_n[1] + dw.more * more) / n_types if n_types else 1.0
    ref = lambda path, b, k: TableRef(spark, path, b, k)
    return Model(ref(words, bits, 1), ref(pairs, bits, 1), ref(ctx, small, 4), ref(fol, small, 1), n_tokens, n_words, n_types, dp, dw, floor)


def score_rows(model: Model, col: pa.Array) -> dict[str, np.ndarray]:
    word, prev, off = tokens(col)
    distinct, at = np.unique(word, return_inverse=True)
    c = model.words.lookup(distinct)[0][at]
    base = np.log10((c + 0.5) / (model.n_tokens + 0.5 * (model.n_words + 1)))
    known, at = np.unique(short(word), return_inverse=True)
    n = model.follows.lookup(known)[0]
    uniform = model.floor / (model.n_words + 1)
    p = ((n - model.word_discounts(n)) / max(model.n_types, 1) + uniform)[at]
    ctx, at = np.unique(short(prev), return_inverse=True)
    total, n1, n2, n3 = model.contexts.lookup(ctx).astype(np.float64)
    d = model.pair_discounts
    back = np.where(total > 0, (d.one * n1 + d.two * n2 + d.more * n3) / np.maximum(total, 1), 1.0)
    high, low = bigram_keys(prev, word)
    order = np.lexsort((low, high))
    n = np.empty(len(word))
    n[order] = model.pairs.lookup(high[order], low[order])[0]
    p = ((n - d(n)) / np.maximum(total, 1)[at]) + back[at] * p

    def summed(x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, off[:-1]) if len(off) > 1 else np.zeros(0)

    return {"n_tokens": np.diff(off), "n_known": per_row(c > 0, off), "base_score": summed(base), "score": summed(np.log10(p))}


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns, n_tokens, n_known, train_tokens, base_score, score (log10 probability) and perplexity of every text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                got = score_rows(model, part.column("__text"))
                out = [pa.array(got["n_tokens"], pa.int64()), pa.array(got["n_known"], pa.int64()), pa.array(np.full(part.num_rows, model.n_tokens)), pa.array(got["base_score"]), pa.array(got["score"])]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *out], [*keep, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    out = docs.select(*keep, F.col("text").alias("__text")).mapInArrow(rows, f"{kinds}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(crc_mod("doc_id", 5) == 1, F.lit(False)).alias("held_out"))
    model = train(docs.where("NOT held_out"))
    return score(docs, model, ["doc_id", "held_out"])
