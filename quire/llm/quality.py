"""Quality classifier: a sparse rule ensemble over text statistics.

Statistics of whole texts are taken in one pass.  Shallow trees fitted to
labelled rows give candidate rules, the conjunctions along their paths; a
lasso logistic fit leaves few of them with a weight; the rules and weights
become one Spark column expression over the statistics.

Fitting uses at most ``FIT_ROWS`` labelled rows, chosen by a hash of doc_id;
statistics and scores cover every row.  Labels, lang, source and doc_id are
never inputs of a score.

Defined results: null and empty texts have statistics of zero and a score
like any other; without labels every score is 0.5, with one label value it is
that value; rows without a label are only scored; repeated rows are scored each;
an empty table gives no rows; extra columns, whatever their names, are kept by
``filter_documents`` and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add, and_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quire.llm.common import carried, crc_mod, land, quoted, ship, table
from quire.llm.repetition import coverage, duplicate_lines
from quire.llm.textwords import Words, mix, per_row, slices, text_beside

FIT_ROWS = 20_000
TREES, DEPTH, LASSO = 24, 3, 0.002
SEED = 3
#: Text bytes whose statistics are taken at once; they take many times that memory.
STEP_BYTES = 1 << 20

_KINDS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "symbol": b"#*$%&<>@^~_=+\\/", "bar": b"|", "bang": b"!?", "point": b".,;:'\"()-", "line": b"\n"}
_IN = {k: np.isin(np.arange(256), list(v)) for k, v in _KINDS.items()}
STATISTICS = ["words", "word_length", "words_per_line", "distinct_words", "short_words", "long_words", "upper_words", "pointed_words", "dup_lines", "repeats", *_KINDS, "beyond_ascii"]


def statistics(col: pa.Array) -> dict[str, np.ndarray]:
    """Statistics of each text, as shares or logarithms."""
    w = Words(col)
    body = w.data[: w.off[-1]]
    n, size = np.maximum(np.diff(w.first), 1), np.maximum(np.diff(w.off), 1)
    h, length = mix(w.hashes()), w.end - w.start
    words = lambda x: per_row(x, w.first) / n
    total = lambda x: per_row(x, w.off) / size
    out = {"words": np.log1p(np.diff(w.first)), "word_length": words(length), "words_per_line": np.log(n / (per_row(body == 0x0A, w.off) + 1))}
    first = np.zeros(len(w), bool)
    first[np.unique(mix(h ^ w.row.astype(np.uint64)), return_index=True)[1]] = True
    last = body[w.end - 1] if len(w) else body
    start = body[w.start] if len(w) else body
    row, a, b, _ = duplicate_lines(w)
    # Distinct words against all on logarithms (Herdan), so that long sound texts don't look repetitive.
    count, distinct = np.diff(w.first), per_row(first, w.first)
    out["distinct_words"] = np.log1p(distinct) / np.maximum(np.log1p(count), 1e-9)
    out |= {"short_words": words(length <= 2), "long_words": words(length >= 12), "upper_words": words(_IN["upper"][start] & (_IN["upper"][last] | ~(_IN["lower"][last]))), "pointed_words": words(~_IN["lower"][last] & (last < 128))}
    out |= {"dup_lines": np.bincount(row, weights=b - a, minlength=len(col)) / size, "repeats": words(coverage(w, h, 3))}
    out |= {k: total(x[body]) for k, x in _IN.items()}
    out["beyond_ascii"] = total(body >= 128)
    return out


def with_statistics(docs: DataFrame, keep: list[str], inside: bool = False) -> DataFrame:
    """``keep`` columns and one ``stat_`` column for each statistic; ``inside``: the text is that of the carried ``doc``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(text_beside(batch), "__text", STEP_BYTES):
                got = statistics(part.column("__text"))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(got[s], pa.float64()) for s in STATISTICS)], [*keep, *(f"stat_{s}" for s in STATISTICS)])

    ship(docs.sparkSession)
    schema = StructType([*(docs.schema[c] for c in keep), *(StructField(f"stat_{s}", DoubleType()) for s in STATISTICS)])
    text = [] if inside else [F.col("text").alias("__text")]
    return docs.select(*(quoted(c) for c in keep), *text).mapInArrow(rows, schema)


class Bound(NamedTuple):
    statistic: str
    above: bool
    limit: float

    def column(self) -> Column:
        c = F.col(f"stat_{self.statistic}")
        return c > self.limit if self.above else c <= self.limit


Rule = tuple[Bound, ...]


def rule_column(rule: Rule) -> Column:
    return reduce(and_, (b.column() for b in rule))


def paths(node, rule: dict[tuple[str, bool], float] | None = None) -> Iterator[Rule]:
    """Every path from the root of a fitted tree, as a conjunction; a bound met again narrows the first."""
    rule = rule or {}
    if rule:
        yield tuple(sorted(Bound(s, up, x) for (s, up), x in rule.items()))
    if node.subtreeDepth():
        split = node.split()
        name, limit = STATISTICS[split.featureIndex()], split.threshold()
        for child, up in ((node.leftChild(), False), (node.rightChild(), True)):
            old = rule.get((name, up), limit)
            yield from paths(child, rule | {(name, up): max(old, limit) if up else min(old, limit)})


class Ensemble(NamedTuple):
    rules: list[tuple[Rule, float]]
    bias: float

    def score(self) -> Column:
        parts = [F.when(rule_column(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules]
        # Summed in a balanced tree: a long chain nests too deep for the planner.
        while len(parts) > 1:
            parts = [reduce(add, parts[i : i + 2]) for i in range(0, len(parts), 2)]
        z = F.lit(self.bias) + parts[0] if parts else F.lit(self.bias)
        return 1 / (1 + F.exp(-z))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, label and statistics of at most ``rows`` labelled documents, chosen by a hash of doc_id among those that may be learned from."""
    may = F.coalesce(crc_mod("doc_id", 3) != 1, F.lit(False))
    truth = labels.where("quality IN (0, 1)").where(may).select(F.col("doc_id").alias("__id"), F.col("quality").alias("__label"))
    chosen = land(truth.orderBy(F.xxhash64("__id"), "__id", "__label").limit(rows), "fit-labels")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))  # ``rows`` rows at most
    stats = with_statistics(found, ["doc_id", "__label"]).withColumnRenamed("__label", "label")
    # Rows that repeat a doc_id don't add to the bound: the one with the least statistics stays, so that a refit agrees.
    least = F.min(F.struct(*(f"stat_{s}" for s in STATISTICS))).alias("least")
    return stats.groupBy("doc_id", "label").agg(least).select("doc_id", "label", "least.*")


def fit(labelled: DataFrame) -> Ensemble:
    """Fit to a bounded table with ``stat_`` columns and ``label`` (0 or 1)."""
    chosen = land(labelled.coalesce(4), "fit-rows")
    seen = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        share = next(iter(seen), None)
        return Ensemble([], 0.0 if share is None else 40.0 * (2 * share - 1))
    assembled = VectorAssembler(inputCols=[f"stat_{s}" for s in STATISTICS], outputCol="x").transform(chosen).select("x", F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(featuresCol="x", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", seed=SEED).fit(assembled)
    found = sorted({r for t in forest.trees for r in paths(t._java_obj.rootNode())})
    as_rules = chosen.select(F.col("label").cast("double").alias("label"), *(rule_column(r).cast("double").alias(f"r{i}") for i, r in enumerate(found)))
    vectors = VectorAssembler(inputCols=[f"r{i}" for i in range(len(found))], outputCol="x").transform(as_rules).select("x", "label")
    lasso = LogisticRegression(featuresCol="x", elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(vectors)
    weights = lasso.coefficients.toArray()
    return Ensemble([(found[i], float(weights[i])) for i in np.flatnonzero(weights).tolist()], float(lasso.intercept))


def with_score(docs: DataFrame, labels: DataFrame, keep: list[str], rows: int = FIT_ROWS, inside: bool = False) -> DataFrame:
    """``keep`` columns with ``__score``; the text is read once to score and, for the rows of the fit, once to learn."""
    model = fit(training_rows(docs, labels, rows))
    return with_statistics(docs, keep, inside).select(*(quoted(c) for c in keep), model.score().alias("__score"))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with all their columns, without those scored under 0.5."""
    return with_score(carried(docs, "doc_id", "text"), labels, ["doc"], inside=True).where("__score >= 0.5").select("doc.*")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return df.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))
