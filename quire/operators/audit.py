"""Checks over loaded corpora: name collisions, duplicates, snapshot diff, checksums.

These are the follow-ups the reference names (incremental update, checksum
validation, deduplication hook) and one hazard it leaves open (two files
flattening to the same item name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flat_name_collisions(items: DataFrame) -> DataFrame:
    """(pos, filename, n) for every flat name given to more than one file of a source."""
    return (
        items.groupBy("pos", "filename")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def dedup_exact(bucket_items: DataFrame) -> DataFrame:
    """First item (lowest item id) of every distinct content hash.

    A ``min_by`` per hash is combined map-side, so a hash shared by a third
    of the corpus (e.g. the empty file) costs one row per map task.
    """
    first = F.min_by(F.struct("external_item_id", "external_source_id"), F.col("external_item_id"))
    return (
        bucket_items.groupBy("content_hash")
        .agg(first.alias("f"))
        .select("content_hash", "f.external_source_id", "f.external_item_id")
    )


def snapshot_diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(source_dir, rel_path, change) between two snapshots of files.

    Only paths and content hashes are shuffled, never the contents.
    """

    def hashed(df: DataFrame, name: str) -> DataFrame:
        return df.select("source_dir", "rel_path", F.sha2(F.col("content"), 256).alias(name))

    j = hashed(previous, "h_prev").join(hashed(current, "h_cur"), ["source_dir", "rel_path"], "full_outer")
    change = (
        F.when(F.col("h_prev").isNull(), F.lit("added"))
        .when(F.col("h_cur").isNull(), F.lit("removed"))
        .when(F.col("h_prev") != F.col("h_cur"), F.lit("changed"))
        .otherwise(F.lit("unchanged"))
    )
    return j.select("source_dir", "rel_path", change.alias("change"))


def checksum_audit(bucket_items: DataFrame) -> DataFrame:
    """Stored content re-hashed and compared with the recorded ``content_hash`` (R2)."""
    return bucket_items.withColumn("ok", F.sha2(F.col("content"), 256) == F.col("content_hash"))


def recently_modified(files: DataFrame, since) -> DataFrame:
    """Files changed at or after ``since`` (R3); needs the ``modified`` column of the tree scan."""
    return files.where(F.col("modified") >= F.lit(since).cast("timestamp"))
