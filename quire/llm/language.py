"""Language ID by language-bitmask n-gram filters.

The filter is a bit-sliced Bloom filter: each row has one bit for each
language, so the AND of the rows of an n-gram's hashes gives all languages
that contain it at once.  A text's count of set bits for each language,
corrected for that language's false positives, decides.

Every n-gram of the training texts is in the filter.  The filter has 8 rows
for each n-gram of the language with most of them, and 2^MAX_BITS rows at
most, so its size is bounded: past that it only has more false positives,
which are measured and corrected for.  Spark builds it: the bits of each row
are a combined OR, and only the finished rows reach the driver.

Defined results: null texts and texts without a letter are ``und`` with score
0; languages tie in favour of the one with more training text; without any
training language all texts are ``und``; repeated rows are judged each; empty
tables give no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import crc_mod, land, ship, table
from quire.llm.textwords import mix, per_row, slices, text_bytes

HASHES = 2
ROWS_A_GRAM, MAX_BITS = 8, 22
GRAM = 4  # bytes

# ASCII that is no letter counts as a space, so junk and layout say nothing about the language.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def grams(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """4-byte n-grams of lower-cased texts, with a space before and two behind, and the n + 1 row offsets."""
    data, off = text_bytes(pc.utf8_lower(col))
    size = np.diff(off) + 3
    to = np.concatenate([[0], np.cumsum(size)])
    body = np.full(to[-1] + GRAM, 0x20, np.uint8)
    n = int(off[-1])
    body[np.arange(n) + np.repeat(np.arange(len(size)) * 3 + 1, np.diff(off))] = _FOLD[data[:n]]
    view = np.ndarray((len(body) - GRAM,), "<u4", buffer=body, strides=(1,))
    inside = np.ones(len(view), bool)
    for k in range(1, GRAM):
        inside[to[1:] - k] = False
    ok = inside & (view != 0x20202020)
    return view[ok], np.concatenate([[0], np.cumsum(ok)])[to]


def row_of(gram: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The filter row of each n-gram's k-th hash."""
    return (mix(gram.astype(np.uint64) + np.uint64((k + 1) << 40)) >> np.uint64(64 - bits)).astype(np.int64)


class Filter(NamedTuple):
    languages: list[str]
    rows: np.ndarray  # (2**bits, words of 64 languages)
    bits: int
    false: np.ndarray  # chance of a false positive, by language

    def masks(self, gram: np.ndarray) -> np.ndarray:
        """Bits of the languages that hold each n-gram."""
        out = self.rows[row_of(gram, 0, self.bits)]
        for k in range(1, HASHES):
            out &= self.rows[row_of(gram, k, self.bits)]
        return out

    def score(self, col: pa.Array) -> tuple[list[str], np.ndarray]:
        gram, off = grams(col)
        masks = self.masks(gram)
        total = np.maximum(np.diff(off), 1)
        est = np.empty((len(self.languages), len(col)))
        for i in range(len(self.languages)):
            share = per_row(masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1), off) / total
            est[i] = np.maximum(share - self.false[i], 0) / max(1 - self.false[i], 1e-9)
        best = est.argmax(0)
        high, all_ = est.max(0), est.sum(0)
        return [self.languages[i] for i in best.tolist()], np.where(all_ > 0, high / np.maximum(all_, 1e-300), 0.0)


def learn(docs: DataFrame) -> Filter | None:
    """Learn from documents (text, lang); rows with a null of either are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                lang = part.column("lang")
                for value in pc.unique(lang):
                    got, n = np.unique(grams(part.column("text").filter(pc.equal(lang, value)))[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([value.as_py()] * len(got), pa.string()), pa.array(got.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    ship(docs.sparkSession)
    counts = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    # The n-grams of a language are many rows; its totals are combined sums, so no task gathers a language.
    counts = land(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("grams")).collect()  # one row a language
    if not sizes:
        return None
    languages = [r["lang"] for r in sorted(sizes, key=lambda r: (-r["total"], r["lang"]))]
    most = max(r["grams"] for r in sizes)
    bits = min(MAX_BITS, max(10, (ROWS_A_GRAM * most - 1).bit_length()))
    number = {x: i for i, x in enumerate(languages)}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            gram = batch.column("gram").to_numpy()
            word, mask = lang // 64, (np.uint64(1) << (lang % 64).astype(np.uint64)).view(np.int64)
            for k in range(HASHES):
                yield pa.RecordBatch.from_arrays([pa.array(row_of(gram, k, bits)), pa.array(word), pa.array(mask)], ["row", "word", "mask"])

    set_ = counts.select("lang", "gram").mapInArrow(placed, "row long, word long, mask long").groupBy("row", "word").agg(F.bit_or("mask").alias("mask"))
    got = set_.select(F.col("row").cast("int").alias("row"), F.col("word").cast("int").alias("word"), "mask").toArrow()  # 2^MAX_BITS rows for 64 languages at most
    rows = np.zeros((1 << bits, -(-len(languages) // 64)), np.uint64)
    rows[got["row"].to_numpy(), got["word"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
    false = np.array([float((rows[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean()) ** HASHES for i in range(len(languages))])
    return Filter(languages, rows, bits, false)


def predict(docs: DataFrame, model: Filter | None, keep: list[str]) -> DataFrame:
    """``keep`` columns with lang_pred and score."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = model_of.value
        for batch in batches:
            for part in slices(batch, "__text"):
                text = part.column("__text")
                letter = pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_numpy(zero_copy_only=False)
                names, score = held.score(text) if held else (["und"] * part.num_rows, np.zeros(part.num_rows))
                names = [x if ok else "und" for x, ok in zip(names, letter.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(names, pa.string()), pa.array(np.where(letter, score, 0.0))], [*keep, "lang_pred", "score"])

    ship(docs.sparkSession)
    model_of = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_BITS
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(rows, f"{kinds}, lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"))
    model = learn(docs.where("NOT held_out"))
    return predict(docs, model, ["doc_id", "held_out"])
