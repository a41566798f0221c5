"""Per-source counts and the nested sync report.

Sources without items are kept.  Neither step joins the item table to the
source table on the source key (a hot source would land in one task):
items are aggregated first, and only the small aggregate meets the sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.sizing import bounded_broadcast
from quire.operators.stage import materialize


def items_per_source(bucket_sources: DataFrame, bucket_items: DataFrame) -> DataFrame:
    """A1 + J3: source_id, source_name, n_items (0 for an empty source)."""
    # One row per source that has items: landed once, then broadcast behind the bound.
    counts = materialize(
        bucket_items.groupBy("external_source_id").agg(F.count(F.lit(1)).alias("n_items")), "counts"
    )
    return (
        bucket_sources.select(
            F.col("external_source_id").cast("long").alias("source_id"),
            F.col("external_source_name").alias("source_name"),
        )
        .join(bounded_broadcast(counts.withColumnRenamed("external_source_id", "source_id")), "source_id", "left")
        .select("source_id", "source_name", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"))
    )


def report_rows(bucket_sources: DataFrame, bucket_items: DataFrame) -> DataFrame:
    """Flat report: one row per item, plus one null-item row per empty source."""
    names = bucket_sources.select(
        F.col("external_source_id").cast("long").alias("source_id"),
        F.col("external_source_name").alias("source_name"),
    )
    items = bucket_items.select(
        F.col("external_source_id").cast("long").alias("source_id"),
        F.col("external_item_id").alias("item_id"),
        F.col("url").alias("item_name"),
    )
    counts = items_per_source(bucket_sources, bucket_items)
    empty = counts.where(F.col("n_items") == 0).select(
        "source_id", "source_name", F.lit(None).cast("long").alias("item_id"),
        F.lit(None).cast("string").alias("item_name"),
    )
    full = items.join(bounded_broadcast(names), "source_id").select(
        "source_id", "source_name", "item_id", "item_name"
    )
    return full.unionByName(empty)


#: Items in one row of the nested report.
PART_ITEMS = 10_000


def sync_report(bucket_sources: DataFrame, bucket_items: DataFrame, part_items: int = PART_ITEMS) -> DataFrame:
    """Nested report (A2): source_id, source_name, part, items[item_id, item_name] sorted by id.

    A source has one row for every ``part_items`` ids from its first item's on,
    counted from 0 (rows without items are left out); an empty source has one
    row with an empty list.  Lists are gathered by (source, part), so no task
    gathers a source, whatever its share of the items.
    """
    counts = items_per_source(bucket_sources, bucket_items)
    sid = F.col("external_source_id").cast("long").alias("source_id")
    first = materialize(bucket_items.groupBy(sid).agg(F.min("external_item_id").alias("first_id")), "first-ids")
    rows = bucket_items.select(sid, F.col("external_item_id").alias("item_id"), F.col("url").alias("item_name"))
    part = F.floor((F.col("item_id") - F.col("first_id")) / part_items).cast("long").alias("part")
    lists = (
        rows.join(bounded_broadcast(first), "source_id")
        .groupBy("source_id", part)
        .agg(F.sort_array(F.collect_list(F.struct("item_id", "item_name"))).alias("items"))
    )
    named = counts.select("source_id", "source_name")
    full = lists.join(bounded_broadcast(named), "source_id").select("source_id", "source_name", "part", "items")
    none = F.array().cast(lists.schema["items"].dataType).alias("items")
    empty = counts.where("n_items = 0").select("source_id", "source_name", F.lit(0).cast("long").alias("part"), none)
    return full.unionByName(empty)
