"""Mixing sources to target weights, in DataFrame functions only.

Each document gets a hash-random key; one range sort by (source, key) puts
every source into random order, whatever its share of the rows; prefix sums
of sizes are sums within a range plus the totals of earlier ranges.  Each
source is then cut at its exact budget: whole epochs first, then the words
that remain are taken along the random order, the last document in part.

Defined results: null texts have size 0; null sources are one source, last
by order; sources without words get target 0; repeated rows count each; an
empty table gives no rows; extra columns are ignored, whatever their names,
and kept as they are by ``mixed_documents``.
Reruns agree, as the key depends on the row alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import carried, land, ranked, table

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def words_in(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Sources (source, source_size) with their ``target`` in words.

    Weights repeat along the sources by code point, null last.  Giving the
    excess of capped sources to the others until none is above its cap is
    water filling: with sources in the order of cap / weight, those up to some
    place are capped and the rest share what is left by weight.
    """
    by_name = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    w = F.element_at(F.array(*(F.lit(x) for x in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    df = sizes.withColumn("weight", w.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").cast("binary").asc_nulls_last())
    df = df.withColumns({"all_words": F.sum("source_size").over(everything), "all_weight": F.sum("weight").over(everything)})
    before = {c: F.coalesce(F.sum(c).over(level.rowsBetween(*_BEFORE)), F.lit(0)) for c in ("cap", "weight")}
    # What a unit of weight gets if all sources before this one are capped.
    df = df.withColumn("unit", (F.col("all_words") - before["cap"]).cast("double") / (F.col("all_weight") - before["weight"]))
    df = df.withColumn("free", F.col("cap").cast("double") >= F.col("unit") * F.col("weight"))
    # The first source that its share doesn't cap sets the unit for all after it.
    df = df.withColumn("unit", F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "unit"))).over(everything)["unit"])
    share = F.col("unit") * F.col("weight")
    cap = F.col("cap").cast("double")
    return df.select("source", "source_size", F.when(F.col("unit").isNull() | (share > cap), cap).otherwise(share).alias("target"))


def mix(docs: DataFrame, size: str = "size", key: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix-1") -> DataFrame:
    """Add source_size, target, taken (words, repeats counted) to documents with ``source`` and a size.

    ``docs`` is read twice, so pass landed rows.
    """
    sizes = docs.groupBy("source").agg(F.sum(size).alias("source_size"))
    goals = targets(sizes, weights, max_epochs).withColumn("budget", F.round("target").cast("long"))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")).cast("binary"))  # a null key hashes the seed alone
    keyed = docs.withColumn("_order", order)
    placed = ranked(keyed, ["source", "_order", size], "mix")
    # One row for each range and source: at most (ranges + sources) rows.
    held = placed.groupBy("source", "_part").agg(F.sum(size).alias("_held"))
    held = held.withColumn("_base", F.coalesce(F.sum("_held").over(Window.partitionBy("source").orderBy("_part").rowsBetween(*_BEFORE)), F.lit(0)))
    within = Window.partitionBy("_part", "source").orderBy("_pos").rowsBetween(*_BEFORE)
    placed = placed.withColumn("_in", F.coalesce(F.sum(size).over(within), F.lit(0)))
    held = held.select(F.col("source").alias("_s"), F.col("_part").alias("_p"), "_base")
    goals = goals.select(F.col("source").alias("_g"), "source_size", "target", "budget")
    out = placed.join(held, placed["source"].eqNullSafe(held["_s"]) & (placed["_part"] == held["_p"]))
    out = out.join(goals, out["source"].eqNullSafe(goals["_g"]))
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    start = F.col("_base") + F.col("_in")
    rest = F.col("budget") - epochs * F.col("source_size") - start
    taken = epochs * F.col(size) + F.greatest(F.lit(0), F.least(rest, F.col(size)))
    return out.withColumn("taken", taken.cast("long")).drop("_s", "_p", "_g", "_order", "_part", "_pos", "_base", "_in", "budget")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Documents with all their columns, each as often as the mix takes it (a part counts from half a document on)."""
    rows = carried(docs, "source", F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string")).alias("key"), words_in("text").alias("size"))
    rows = land(rows.withColumn("row", F.monotonically_increasing_id()), "mix-input")
    taken = mix(rows.select("row", "source", "key", "size"), "size", "key", weights, max_epochs)
    copies = F.expr("taken div size + int(2 * (taken % size) >= size)")
    wanted = taken.where("taken > 0").select("row", copies.alias("copies")).where("copies > 0")
    out = rows.select("row", "doc").join(wanted, "row")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc.*")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words_in("text").alias("size"))
    return mix(land(docs, "sizes")).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), named AS (
  SELECT *, 3 * source_size AS cap, (ARRAY[1, 2, 3])[((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM sizes
), levels AS (
  SELECT *, cap / weight AS level,
    ((sum(source_size) OVER ())::BIGINT - coalesce(sum(cap) OVER w, 0)::BIGINT)::DOUBLE / ((sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER w, 0)::BIGINT) AS unit
  FROM named WINDOW w AS (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT unit FROM levels WHERE cap::DOUBLE >= unit * weight ORDER BY level, unit LIMIT 1
), goals AS (
  SELECT n.source, n.source_size, CASE WHEN c.unit IS NULL OR c.unit * n.weight > n.cap THEN n.cap::DOUBLE ELSE c.unit * n.weight END AS target
  FROM named n LEFT JOIN chosen c ON true
), budgets AS (
  SELECT *, round(target)::BIGINT AS budget, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs FROM goals
), placed AS (
  SELECT doc_id, source, size,
    coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(concat_ws(':', 'mix-1', doc_id::VARCHAR)), size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM docs
)
SELECT p.doc_id, p.size, b.source_size, b.target,
  (b.epochs * p.size + greatest(0, least(b.budget - b.epochs * b.source_size - p.start, p.size)))::BIGINT AS taken
FROM placed p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source
"""
