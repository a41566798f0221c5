"""Incremental sync: each micro-batch of landed snapshot files refreshes its sources.

The reference only knows a full refresh of the whole bucket; its notes name
incremental updates as the next step.  Here a landing folder receives commits,
folders of parquet ``files`` rows (``schemas.FILES``) whose names ascend, each
holding complete snapshots of one or more source folders.  For every
micro-batch the sources present in it are replaced in the bucket: their old
items are dropped and their new items loaded (same processors, same gate),
other sources keep their items.

A micro-batch may see only some files of a commit, so it only tells which
commits have news; their folders are read whole, and the last micro-batch of a
commit leaves the bucket with all of it.  Sources are matched by folder: two
references of one repository share their display name.  A known folder keeps
its source id, an unchanged file its item id.

A micro-batch writes the slots of its folders only and appears by one commit
(:mod:`quire.operators.store`), so a replay after a crash ends in the same
state.  What can't be loaded comes back as rejects.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire import schemas
from quire.operators import bucket, process
from quire.operators.sizing import bounded_broadcast
from quire.operators.stage import materialize
from quire.operators.store import TableStore, slot_of

# The folder of a file path.
_FOLDER = r"^(.*)/[^/]*$"


def refresh_sources(
    spark: SparkSession,
    files: DataFrame,
    manifest: DataFrame,
    bucket_id: int,
    sources_table: str,
    items_table: str,
    kind: str = "FlattenFiles",
    store: TableStore | None = None,
) -> DataFrame:
    """Replace, inside one bucket, the sources whose folders appear in ``files``; returns the rejects.

    Folders that the manifest doesn't have are ``unknown_source`` rejects.
    """
    bucket._check_bucket_id(bucket_id)
    store = store or TableStore(spark, sources_table, items_table)
    store.ensure()
    present = materialize(files.select("source_dir").distinct(), "stream-folders")
    man = materialize(manifest.join(present, "source_dir", "left_semi"), "stream-manifest")
    none = F.lit(None).cast("string")
    unknown = present.join(man, "source_dir", "left_anti").select("source_dir", none.alias("rel_path"), F.lit("unknown_source").alias("reason"), none.alias("detail"))
    if man.limit(1).count() == 0:
        return unknown
    known = man.select("source_dir").distinct()
    items, rejects = process.process(files, man, kind)
    src_base, item_base = store.last_ids()
    before = materialize(store.stored_sources(bucket_id).drop("generation"), "stream-sources")
    ours = before.join(known, "source_dir", "left_semi")
    sources = bucket.load_sources(man, bucket_id, id_base=src_base, previous=ours)
    slots = [r["slot"] for r in known.select(slot_of("source_dir").alias("slot")).distinct().collect()]
    old_items = store.stored_items(bucket_id, slots).join(bounded_broadcast(known), "source_dir", "left_semi")
    new_items = bucket.load_items(items, sources, id_base=item_base, keep=("source_dir", "rel_path"), previous=old_items)
    last_item = bucket.check_gate(new_items)
    whole = before.join(known, "source_dir", "left_anti").unionByName(sources.drop("pos"))
    last_source = sources.agg(F.max("external_source_id").alias("m")).collect()[0]["m"]
    store.replace_folders(bucket_id, known, whole, new_items, (max(src_base, last_source), max(item_base, last_item)))
    return rejects.unionByName(unknown)


def refresh_commits(
    spark: SparkSession,
    commits: list[str],
    manifest: DataFrame,
    bucket_id: int,
    sources_table: str,
    items_table: str,
    kind: str = "FlattenFiles",
) -> DataFrame:
    """Refresh from whole commit folders; a source in several takes the last.  Returns the rejects."""
    rows = spark.read.schema(schemas.FILES).parquet(*commits).withColumn("_commit", F.regexp_extract(F.col("_metadata.file_path"), _FOLDER, 1))
    last = materialize(rows.groupBy("source_dir").agg(F.max("_commit").alias("_commit")), "stream-commits")
    files = rows.join(bounded_broadcast(last), ["source_dir", "_commit"], "left_semi").drop("_commit")
    return refresh_sources(spark, files, manifest, bucket_id, sources_table, items_table, kind)


def _keep_rejects(spark: SparkSession, table: str, rejects: DataFrame, batch_id: int) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schemas.REJECTS}, batch_id bigint) USING parquet PARTITIONED BY (batch_id)")
    names = ", ".join(c for c in spark.table(table).columns if c != "batch_id")
    view = f"rejects_{uuid.uuid4().hex}"
    rejects.createOrReplaceTempView(view)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = {int(batch_id)}) SELECT {names} FROM {view}")
    spark.catalog.dropTempView(view)


def start(
    spark: SparkSession,
    landing_dir: str,
    manifest: DataFrame,
    bucket_id: int,
    checkpoint_location: str,
    sources_table: str = "bucket_sources",
    items_table: str = "bucket_items",
    kind: str = "FlattenFiles",
    available_now: bool = False,
    interval: str = "10 minutes",
    rejects_table: str | None = None,
) -> StreamingQuery:
    """Start the incremental sync over the commit folders that ``landing_dir`` (a glob) matches.

    With ``rejects_table`` the rejects of each micro-batch are kept there, in
    a partition of its own that a replay replaces.
    """
    stream = spark.readStream.schema(schemas.FILES).parquet(landing_dir)
    stream = stream.select(F.regexp_extract(F.col("_metadata.file_path"), _FOLDER, 1).alias("commit"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        commits = [r["commit"] for r in batch.distinct().collect()]  # folder names, as many as the trigger took
        if not commits:
            return
        rejects = refresh_commits(batch.sparkSession, commits, manifest, bucket_id, sources_table, items_table, kind)
        if rejects_table is not None:
            _keep_rejects(rejects.sparkSession, rejects_table, rejects, batch_id)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
