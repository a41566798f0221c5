"""The source catalogue, and the manifest derived from it.

A catalogue is an ordered list of tagged records; ``type`` selects the
branch (``confluence`` needs ``base_url`` and ``space_key``; ``git``, and any
type with a registered reader, needs ``repo_url``).  It is configuration-sized.  ``pos`` keeps the configured
order; output follows it only where order is part of the result (L1).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.functions.naming import logical_name, source_dir

SOURCE_FIELDS = ("type", "repo_url", "reference", "base_url", "space_key")


def sources_frame(spark: SparkSession, sources: Iterable[dict]) -> DataFrame:
    """Catalogue from configuration records, numbered in the given order."""
    rows = [(i, *[s.get(f) for f in SOURCE_FIELDS]) for i, s in enumerate(sources)]
    return spark.createDataFrame(rows, schemas.SOURCES)


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue from JSON files, each holding one array of source records.

    The array position is the configured order; files are ordered by path.
    A file that isn't one JSON array of records fails the read: read as no
    sources, it would empty the bucket.
    """
    item = ", ".join(f"{f} string" for f in SOURCE_FIELDS)
    value = F.col("content").cast("string")
    array = F.when(value.rlike(r"(?s)^\s*\[.*\]\s*$"), F.from_json(value, f"array<struct<{item}>>"))
    docs = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), array.alias("arr"))
    if docs.count() < len(docs.inputFiles()):  # scans skip empty files; catalogues are few and small
        raise ValueError(f"malformed source catalogue: an empty file in {path}")
    broken = F.raise_error(F.concat(F.lit("malformed source catalogue: "), "file"))
    records = F.when(F.col("arr").isNull() | F.exists("arr", lambda s: s.isNull()), broken).otherwise(F.col("arr"))
    exploded = docs.select("file", F.posexplode(records).alias("i", "s"))
    from quire.operators.numbering import dense_number

    numbered = dense_number(exploded, ["file", "i"], "pos", start=0)
    return numbered.select(F.col("pos").cast("int").alias("pos"), *[F.col(f"s.{f}").alias(f) for f in SOURCE_FIELDS])


def invalid_sources(sources: DataFrame) -> DataFrame:
    """Rows that name a type without a reader or lack a field their type requires."""
    from quire.sources.readers import READERS

    t = F.col("type")
    reason = (
        F.when(~t.isin(*READERS) | t.isNull(), F.lit("unknown_type"))
        .when((t != "confluence") & F.col("repo_url").isNull(), F.lit("missing_repo_url"))
        .when((t == "confluence") & (F.col("base_url").isNull() | F.col("space_key").isNull()),
              F.lit("missing_space"))
    )
    return sources.withColumn("reason", reason).where(F.col("reason").isNotNull())


def manifest(sources: DataFrame, root: str | None = None) -> DataFrame:
    """One manifest row per configured source (P20): pos, names, folder, original record.

    The same source configured twice yields two rows with one folder.  With
    ``root`` (the landing folder) a ``local_path`` column locates the folder.
    """
    out = sources.select(
        "pos",
        logical_name(*[F.col(c) for c in ("type", "repo_url", "base_url", "space_key")]).alias("logical_name"),
        source_dir(*[F.col(c) for c in SOURCE_FIELDS]).alias("source_dir"),
        "type",
        F.struct(*SOURCE_FIELDS).alias("original_source"),
    )
    if root is not None:
        out = out.withColumn("local_path", F.concat(F.lit(root.rstrip("/") + "/"), F.col("source_dir")))
    return out
