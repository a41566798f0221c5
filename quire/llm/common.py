"""Small Spark helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.stage import land
from quire.session import ship

__all__ = ["carried", "crc_mod", "land", "quoted", "ranked", "ship", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def carried(df: DataFrame, *names: str) -> DataFrame:
    """All columns of ``df`` as one struct ``doc`` beside the named ones, so that no name of a caller's meets one used inside; ``doc.*`` gives them back."""
    return df.select(F.struct(*(quoted(c) for c in df.columns)).alias("doc"), *names)


def ranked(df: DataFrame, keys: list[Column | str], label: str) -> DataFrame:
    """Range-sort by ``keys``, land the rows, and add ``_part`` (their range) and ``_pos`` (place in it).

    One range shuffle.  The last sort key is a row number, so equal keys, a
    null id that a third of the rows hold for one, span ranges; pass landed
    rows, whose number doesn't change.  Landing fixes the order, so everything
    computed from ``_part`` and ``_pos`` survives lost executors.
    """
    at = F.monotonically_increasing_id()
    keys = [*keys, "_tie"]
    placed = df.withColumn("_tie", at).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie").withColumn("_at", at)
    placed = land(placed, label)
    return placed.withColumns({"_part": F.shiftright("_at", 33), "_pos": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_at")


def crc_mod(doc_id: str, n: int) -> Column:
    """crc32 of the id's text, modulo n (null ids give null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n
