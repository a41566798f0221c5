"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths, in numpy over whole Arrow slices:
words that lie in an n-gram found twice or more in their text are covered,
and so are lines equal to an earlier line.  A text is rejected where the
share of its characters inside duplicated n-grams or lines is above the
limit for that length.

Hashes have 64 bits and are keyed by row, so equal values mean equal words
within one text (chance of error under 2**-20 for a billion-word text).

Defined results: null or empty texts have zero words and fail the base rule;
texts shorter than an n-gram have no such n-grams; repeated rows are judged
each; empty tables give no rows; extra columns, whatever their names, are kept by
``filter_documents`` and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quire.llm.common import carried, quoted, ship, table
from quire.llm.textwords import Words, mix, per_row, slices, text_beside

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Largest share of characters in duplicated n-grams, by n (longer ones are rarer in sound text), and in duplicated lines.
MAX_NGRAM_SHARE = {5: 0.30, 7: 0.25, 10: 0.20}
MAX_LINE_SHARE = 0.30
#: Text bytes measured at once; that takes some forty times as much memory.
STEP_BYTES = 1 << 20

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2**64
_BACK = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    s = np.sort(keys)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def coverage(w: Words, hashes: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in an n-word window that occurs twice or more in their row."""
    m = len(w) - n + 1
    if m <= 0:
        return np.zeros(len(w), bool)
    roll = np.zeros(m, np.uint64)
    for k in range(n):
        roll = roll * _STEP + hashes[k : k + m]
    inside = w.row[:m] == w.row[n - 1 :]
    at = np.flatnonzero(inside)
    hit = at[_repeated(mix(roll[at] ^ mix(w.row[at].astype(np.uint64) + np.uint64(n << 40))))]
    edge = np.bincount(hit, minlength=len(w) + 1)[: len(w) + 1] - np.bincount(hit + n, minlength=len(w) + 1)[: len(w) + 1]
    return np.cumsum(edge)[: len(w)] > 0


def duplicate_lines(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines (between newlines) that hold a word and equal an earlier line of their row: row, start and end of each, and the word-free ones left out."""
    n = int(w.off[-1])
    breaks = np.flatnonzero(w.data[:n] == 0x0A)
    start = np.concatenate([w.off[:-1], breaks + 1])
    order = np.argsort(start, kind="stable")
    start = start[order]
    # An empty row's line and a line that ends its row start where the next row starts: rows in order settle whose it is.
    row = np.concatenate([np.arange(len(w.off) - 1), np.searchsorted(w.off, breaks, side="right") - 1])[order]
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    end = np.empty_like(start)
    same = row[1:] == row[:-1]
    end[:-1] = np.where(same, start[1:] - 1, w.off[row[:-1] + 1])
    end[-1:] = w.off[row[-1:] + 1]
    has = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, row = start[has], end[has], row[has]
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[w.data[:n]] * _powers(_STEP, n), dtype=np.uint64)])
    h = (total[end] - total[start]) * _powers(_BACK, n + 1)[start] + (end - start).astype(np.uint64)
    key = mix(h ^ mix(row.astype(np.uint64) + np.uint64(1)))
    again = np.ones(len(key), bool)
    again[np.unique(key, return_index=True)[1]] = False
    return row[again], start[again], end[again], has


def measures(col: pa.Array) -> dict[str, np.ndarray]:
    """Counts of each row of a text column."""
    w = Words(col)
    rows, n = len(col), int(w.off[-1])
    points = np.concatenate([[0], np.cumsum((w.data[:n] & 0xC0) != 0x80)])
    chars = points[w.end] - points[w.start]
    hashes = mix(w.hashes())
    out = {"n_words": np.diff(w.first), "word_chars": per_row(chars, w.first), "n_symbols": per_row(_SYMBOL[w.data[:n]], w.off)}
    row, start, end, _ = duplicate_lines(w)
    out["n_dup_lines"] = np.bincount(row, minlength=rows)
    out["dup_line_chars"] = np.bincount(row, weights=(points[end] - points[start]), minlength=rows).astype(np.int64)
    out["text_chars"] = points[w.off[1:]] - points[w.off[:-1]]
    out["n_repeat_words"] = per_row(coverage(w, hashes, 3), w.first)
    for k in MAX_NGRAM_SHARE:
        out[f"dup_{k}gram_chars"] = per_row(np.where(coverage(w, hashes, k), chars, 0), w.first)
    return out


_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "text_chars", "dup_line_chars", *(f"dup_{k}gram_chars" for k in MAX_NGRAM_SHARE)]


def repetition(docs: DataFrame, keep: list[str] | None = None, inside: bool = False) -> DataFrame:
    """The measures of every document with ``base_failed`` and ``kept``; ``keep`` names the columns carried along.

    ``text`` is read in any case, ``inside`` the carried ``doc`` if so asked.
    """
    ship(docs.sparkSession)
    keep = keep or ["doc_id"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(text_beside(batch), "__text", STEP_BYTES):
                got = measures(part.column("__text"))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(got[c], pa.int64()) for c in _COLUMNS)], [*keep, *(f"__{c}" for c in _COLUMNS)])

    schema = StructType([*(docs.schema[c] for c in keep), *(StructField(f"__{c}", LongType()) for c in _COLUMNS)])
    text = [] if inside else [F.col("text").alias("__text")]
    df = docs.select(*(quoted(c) for c in keep), *text).mapInArrow(count, schema)
    c = lambda name: F.col(f"__{name}")
    failed = (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words"))
    sound = c("dup_line_chars") <= MAX_LINE_SHARE * c("text_chars")
    for k, most in MAX_NGRAM_SHARE.items():
        sound &= c(f"dup_{k}gram_chars") <= most * c("word_chars")
    return df.withColumn("__base_failed", failed).withColumn("__kept", ~failed & sound)


def filter_documents(docs: DataFrame) -> DataFrame:
    """Documents with all their columns, without those that the rules reject."""
    return repetition(carried(docs), ["doc"], inside=True).where("__kept").select("doc.*")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = repetition(table(spark, sf_dir, "documents"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "text_chars", "dup_line_chars", *(f"dup_{k}gram_chars" for k in MAX_NGRAM_SHARE)]
    return df.select("doc_id", *(F.col(f"__{c}").alias(c) for c in names))
