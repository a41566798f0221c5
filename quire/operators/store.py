"""The bucket as tables with one commit.

Rows lie in partitions ``(bucket_id, slot, generation)``; the slot is a hash of
the source's folder.  A write fills partitions of a new generation, which no
reader looks at, and then appends one row to the commit table: a version that
names the generation of the sources and of every slot.  That row is one file
that appears at once, so a reader sees the bucket before or after a refresh,
never between, and a refresh that stops anywhere leaves the bucket whole.
Generations that the last version doesn't name are removed afterwards, or by
the next write.

A refresh of some folders writes only their slots; files of other slots stay.
A bucket has one writer at a time.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.operators.sizing import bounded_broadcast
from quire.operators.stage import materialize

SLOTS = 16


def slot_of(source_dir: str) -> Column:
    return F.pmod(F.xxhash64(source_dir), F.lit(SLOTS)).cast("int")


class TableStore:
    """Sources and items of buckets in two tables, and their commits in a third."""

    def __init__(self, spark: SparkSession, sources_table: str = "bucket_sources", items_table: str = "bucket_items"):
        self.spark, self.sources_table, self.items_table = spark, sources_table, items_table
        self.commits_table = f"{sources_table}_commits"

    def tables(self) -> dict[str, tuple[str, str]]:
        """Schema and partition columns of each table."""
        return {
            self.sources_table: (schemas.STORED_SOURCES, "bucket_id, generation"),
            self.items_table: (schemas.STORED_ITEMS, "bucket_id, slot, generation"),
            self.commits_table: (schemas.COMMITS, "bucket_id"),
        }

    def ensure(self, location: str | None = None) -> None:
        """Create the tables if need be, below ``location`` if given."""
        for name, (schema, keys) in self.tables().items():
            at = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet PARTITIONED BY ({keys}){at}")

    # ------------------------------------------------------------- reading

    def _table(self, name: str) -> DataFrame:
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def head(self, bucket_id: int) -> Row | None:
        """The last commit of a bucket."""
        own = self._table(self.commits_table).where(F.col("bucket_id") == bucket_id)
        rows = own.orderBy(F.col("version").desc()).limit(1).collect()
        return rows[0] if rows else None

    def last_ids(self) -> tuple[int, int]:
        """The last source and item id given in any bucket."""
        row = self._table(self.commits_table).agg(F.max("last_source_id").alias("s"), F.max("last_item_id").alias("i")).collect()[0]
        return int(row["s"] or 0), int(row["i"] or 0)

    def stored_sources(self, bucket_id: int) -> DataFrame:
        head = self.head(bucket_id)
        at = F.lit(False) if head is None else F.col("generation") == head["sources_at"]
        return self._table(self.sources_table).where((F.col("bucket_id") == bucket_id) & at)

    def stored_items(self, bucket_id: int, slots: list[int] | None = None) -> DataFrame:
        """Items of a bucket, or of some of its slots; the filter is on partitions alone."""
        head = self.head(bucket_id)
        by_generation: dict[int, list[int]] = {}
        for slot, generation in enumerate(head["slots"] if head else []):
            if slots is None or slot in slots:
                by_generation.setdefault(generation, []).append(slot)
        at = F.lit(False)
        for generation, own in by_generation.items():
            at = at | ((F.col("generation") == generation) & F.col("slot").isin(own))
        return self._table(self.items_table).where((F.col("bucket_id") == bucket_id) & at)

    def sources(self, bucket_id: int) -> DataFrame:
        """the sources of a bucket."""
        return self.stored_sources(bucket_id).drop("source_dir", "generation")

    def source(self, bucket_id: int, external_source_id: int) -> DataFrame:
        """F8: one source of a bucket."""
        return self.sources(bucket_id).where(F.col("external_source_id") == external_source_id)

    def items(self, bucket_id: int) -> DataFrame:
        return self.stored_items(bucket_id).drop("source_dir", "rel_path", "slot", "generation")

    # ------------------------------------------------------------- writing

    def _write(self, table: str, df: DataFrame) -> None:
        df.select(*self.spark.table(table).columns).write.insertInto(table)

    def _write_items(self, bucket_id: int, items: DataFrame, generation: int, before: list[int]) -> list[int]:
        """Write items as a new generation; returns the generations their contents lie in, if these are kept apart."""
        self._write(self.items_table, items.withColumns({"slot": slot_of("source_dir"), "generation": F.lit(generation)}))
        return []

    def _commit(self, bucket_id: int, generation: int, slots: list[int], contents: list[int], last_ids: tuple[int, int]) -> None:
        """Append the version's row, in one file."""
        row = (bucket_id, generation, generation, slots, contents, *last_ids)
        self._write(self.commits_table, self.spark.createDataFrame([row], schemas.COMMITS).coalesce(1))

    def _next_generation(self, bucket_id: int) -> int:
        """A number no earlier write has used, whether it was committed or not."""
        head = self.head(bucket_id)
        return max(time.time_ns() // 1000, 1 + (head["version"] if head else 0))

    def replace(self, bucket_id: int, sources: DataFrame, items: DataFrame, last_ids: tuple[int, int]) -> None:
        """The bucket holds exactly these rows afterwards (K5, K8).

        ``sources`` and ``items`` have the stored columns but slot and
        generation; ``last_ids`` are the largest ids given so far.
        """
        self.clean(bucket_id)  # what a refresh that stopped has left
        g = self._next_generation(bucket_id)
        contents = self._write_items(bucket_id, items, g, [])
        self._write(self.sources_table, sources.withColumn("generation", F.lit(g)))
        self._commit(bucket_id, g, [g] * SLOTS, contents, last_ids)
        self.clean(bucket_id)

    def replace_folders(self, bucket_id: int, folders: DataFrame, sources: DataFrame, items: DataFrame, last_ids: tuple[int, int]) -> None:
        """Items of these folders (``source_dir``) are exactly ``items`` afterwards; ``sources`` are all of the bucket's."""
        self.clean(bucket_id)
        head, g = self.head(bucket_id), self._next_generation(bucket_id)
        folders = materialize(folders.select("source_dir").distinct(), "folders")
        slots = [r["slot"] for r in folders.select(slot_of("source_dir").alias("slot")).distinct().collect()]
        kept = self.stored_items(bucket_id, slots).drop("generation", "slot").join(bounded_broadcast(folders), "source_dir", "left_anti")
        contents = self._write_items(bucket_id, kept.unionByName(items), g, list(head["contents_at"]) if head else [])
        self._write(self.sources_table, sources.withColumn("generation", F.lit(g)))
        at = list(head["slots"]) if head else [0] * SLOTS
        self._commit(bucket_id, g, [g if k in slots else old for k, old in enumerate(at)], contents, last_ids)
        self.clean(bucket_id)

    def clean(self, bucket_id: int) -> int:
        """Remove the generations that the last commit doesn't name; returns how many folders went."""
        head, gone = self.head(bucket_id), 0
        for table, (_, keys) in self.tables().items():
            if "generation" not in keys:
                continue
            inside = "slot=*/generation=*" if "slot" in keys else "generation=*"
            root = [r["data_type"] for r in self.spark.sql(f"DESCRIBE FORMATTED {table}").collect() if r["col_name"] == "Location"][0]
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{root}/bucket_id={int(bucket_id)}/{inside}")
            fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            for status in fs.globStatus(path) or []:  # folders, also of writes that the catalogue never heard of
                folder = status.getPath()
                spec = dict(x.split("=", 1) for x in folder.toString().split("/") if "=" in x and x.split("=", 1)[0] in ("slot", "generation"))
                if int(spec["generation"]) not in self._live(head, table, spec):
                    own = ", ".join(f"{k} = {int(v)}" for k, v in {"bucket_id": bucket_id, **spec}.items())
                    self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({own})")
                    fs.delete(folder, True)  # a table with a location of its own keeps its files
                    gone += 1
        return gone

    def _live(self, head: Row | None, table: str, spec: dict[str, str]) -> list[int]:
        """The generations of a table's partition that the last commit names."""
        if head is None:
            return []
        return [head["slots"][int(spec["slot"])]] if "slot" in spec else [head["sources_at"]]


class DedupStore(TableStore):
    """A bucket whose items refer to contents by hash (R4): each distinct content is stored once.

    A refresh of some folders adds the contents that aren't there yet; what no
    item refers to any more stays until the next full refresh.
    """

    def __init__(self, spark: SparkSession, sources_table: str = "bucket_sources", items_table: str = "bucket_items"):
        super().__init__(spark, sources_table, items_table)
        self.contents_table = f"{items_table}_contents"

    def tables(self) -> dict[str, tuple[str, str]]:
        return {**super().tables(), self.contents_table: (schemas.STORED_CONTENTS, "bucket_id, generation")}

    def contents(self, bucket_id: int) -> DataFrame:
        """content_hash, content of every distinct content."""
        head = self.head(bucket_id)
        return self._contents(bucket_id, list(head["contents_at"]) if head else [])

    def _contents(self, bucket_id: int, generations: list[int]) -> DataFrame:
        rows = self._table(self.contents_table).where(F.col("bucket_id") == bucket_id)
        return rows.where(F.col("generation").isin(generations)).select("content_hash", "content")

    def references(self, bucket_id: int, slots: list[int] | None = None) -> DataFrame:
        """Items without their contents."""
        return super().stored_items(bucket_id, slots).drop("content")

    def stored_items(self, bucket_id: int, slots: list[int] | None = None) -> DataFrame:
        held = self.contents(bucket_id)
        joined = self.references(bucket_id, slots).join(held, "content_hash")
        return joined.select(*self.spark.table(self.items_table).columns)

    def _write_items(self, bucket_id: int, items: DataFrame, generation: int, before: list[int]) -> list[int]:
        # The first item of each hash brings the content; only hashes and ids move to find it.
        first = items.groupBy("content_hash").agg(F.min("external_item_id").alias("external_item_id"))
        if before:
            first = first.join(self._contents(bucket_id, before).select("content_hash"), "content_hash", "left_anti")
        first = materialize(first.select("external_item_id"), "first-items")
        new = items.select("external_item_id", "content_hash", "content").join(bounded_broadcast(first), "external_item_id", "left_semi")
        self._write(self.contents_table, new.select("content_hash", "content", F.lit(bucket_id).alias("bucket_id"), F.lit(generation).alias("generation")))
        super()._write_items(bucket_id, items.withColumn("content", F.lit(None).cast("string")), generation, [])
        return [*before, generation]

    def _live(self, head: Row | None, table: str, spec: dict[str, str]) -> list[int]:
        if table == self.contents_table:
            return list(head["contents_at"]) if head else []
        return super()._live(head, table, spec)
