"""The bucket: two tables standing in for the remote knowledge store.

``bucket_sources`` and ``bucket_items`` (schemas in :mod:`quire.schemas`) are
kept by :mod:`quire.operators.store`.  Creating sources and items (K3, K4) is a
projection with dense ids; deletes (K6, K7) are anti-joins; list and get
(F8, F9) are filters that prune to one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import lossy_utf8
from quire.operators.numbering import dense_number, rank_within
from quire.operators.sizing import bounded_broadcast
from quire.operators.stage import land, materialize

# Fixed value: the state every created item must report.
SUBMITTED = "Submitted"
CREATED_STATE = "Active"


def load_sources(
    manifest: DataFrame,
    bucket_id: int,
    id_base: int = 0,
    updated_by: int = 0,
    as_of: str | None = None,
    previous: DataFrame | None = None,
) -> DataFrame:
    """Create one source per manifest row (K3); ids follow ``pos`` and start after ``id_base``.

    Keeps ``pos`` so items can be attached, and the folder, if the manifest has
    it; :func:`source_table` drops both.  With ``previous`` (source_dir,
    external_source_id) folders that were there before keep their ids.
    """
    _check_bucket_id(bucket_id)
    named = manifest.select("pos", "logical_name", *(c for c in ("source_dir",) if c in manifest.columns))
    if previous is None:
        numbered = dense_number(named, ["pos"], "sid", start=id_base + 1)
    else:  # configuration-sized, as is the manifest; a folder configured twice has two sources
        nth = lambda order: F.row_number().over(Window.partitionBy("source_dir").orderBy(order))
        before = previous.select("source_dir", nth("external_source_id").alias("n"), F.col("external_source_id").cast("long").alias("sid"))
        met = materialize(named.withColumn("n", nth("pos")).join(before, ["source_dir", "n"], "left").drop("n"), "known-sources")
        new = dense_number(met.where("sid is null").drop("sid"), ["pos"], "sid", start=id_base + 1)
        numbered = met.where("sid is not null").unionByName(new)
    created = numbered.select(
        F.lit(bucket_id).cast("int").alias("bucket_id"),
        F.col("sid").cast("int").alias("external_source_id"),
        F.col("logical_name").alias("external_source_name"),
        F.lit(updated_by).cast("int").alias("updated_by"),
        F.lit(as_of).cast("string").alias("updated_datetime"),
        "pos",
        *(c for c in ("source_dir",) if c in manifest.columns),
    )
    # Configuration-sized; landed once so ids and size checks never recompute it.
    return materialize(created, "sources")


def source_table(loaded_sources: DataFrame) -> DataFrame:
    return loaded_sources.drop("pos", "source_dir")


def load_items(
    items: DataFrame,
    loaded_sources: DataFrame,
    id_base: int = 0,
    backend_state=None,
    as_of: str | None = None,
    keep: tuple[str, ...] = (),
    with_content: bool = True,
    previous: DataFrame | None = None,
) -> DataFrame:
    """Create one item per processed item.

    Item ids are dense in (source id, filename, rel_path, content hash) order,
    after ``id_base``.  ``backend_state`` is an optional column with the state a
    backend reported; unset means every item is ``Submitted``.  ``keep``
    names extra item columns carried to the output.  ``with_content=False``
    numbers the same items without their contents, for uses that only need
    ids and hashes.  With ``previous`` (:func:`stable_ids`) items that were
    there before keep their ids and only the others are numbered.

    Contents are read and hashed once and landed with a row number; keys
    alone are range-sorted, and ids meet the contents by that number.
    """
    src = loaded_sources.select(
        "pos",
        F.col("bucket_id").cast("long").alias("bucket_id"),
        F.col("external_source_id").cast("long").alias("external_source_id"),
    )
    state = F.coalesce(backend_state, F.lit(SUBMITTED)) if backend_state is not None else F.lit(SUBMITTED)
    attached = items.join(bounded_broadcast(src), "pos").select(
        "bucket_id",
        "external_source_id",
        "source_dir",
        "rel_path",
        F.col("filename").alias("url"),
        lossy_utf8("content").alias("content"),
        state.alias("processing_state"),
        *(c for c in keep if c not in ("source_dir", "rel_path")),
    ).withColumn("content_hash", F.sha2("content", 256))
    if not with_content:
        attached = attached.drop("content")
    staged = land(attached.withColumn("__row", F.monotonically_increasing_id()), "items")
    # The content hash breaks ties of a table input that repeats a path (a fixed-size
    # key: sort keys are sampled on the driver, so the text itself must not be one).
    order = ["external_source_id", "url", "rel_path", "content_hash"]
    if previous is None:
        ids = dense_number(staged.select(*order, "__row"), order, "external_item_id", start=id_base + 1).select("__row", "external_item_id")
    else:
        ids = stable_ids(staged.select(*order, "__row"), previous, order, id_base)
    return staged.join(ids, "__row").select(
        "bucket_id",
        "external_source_id",
        "external_item_id",
        "url",
        *(["content"] if with_content else []),
        "content_hash",
        "processing_state",
        F.lit(CREATED_STATE).alias("state"),
        F.lit(as_of).cast("string").alias("updated_datetime"),
        *keep,
    )


def stable_ids(keys: DataFrame, previous: DataFrame, order: list[str], id_base: int) -> DataFrame:
    """(__row, external_item_id): unchanged items keep their id, the others are numbered after ``id_base``.

    An item is unchanged if its (source, path, content hash) was there
    before; of several alike the k-th keeps the k-th id.  Only keys move:
    repeats are ranked by range sorts, so no task gathers those of one key.
    """
    same = ["external_source_id", "rel_path", "content_hash"]
    now = _nth_alike(keys, same, "__row")
    before = _nth_alike(previous.select(*same, "external_item_id"), same, "external_item_id")
    met = now.join(before, [*same, "__nth"], "left")
    met = materialize(met.select("__row", *order, "external_item_id"), "stable-ids")
    kept = met.where("external_item_id is not null").select("__row", "external_item_id")
    new = met.where("external_item_id is null").drop("external_item_id")
    return kept.union(dense_number(new, order, "external_item_id", start=id_base + 1).select("__row", "external_item_id"))


def _nth_alike(df: DataFrame, same: list[str], order: str) -> DataFrame:
    """Add ``__nth``, the place among rows alike; only keys that repeat are ranked."""
    repeated = materialize(df.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*same), "repeated")
    if not repeated.limit(1).count():
        return df.withColumn("__nth", F.lit(0).cast("long"))
    repeated = bounded_broadcast(repeated)
    once = df.join(repeated, same, "left_anti").withColumn("__nth", F.lit(0).cast("long"))
    return once.unionByName(rank_within(df.join(repeated, same, "left_semi"), same, [order], "__nth"))


def gate_violations(bucket_items: DataFrame) -> DataFrame:
    """Items whose processing state is not ``Submitted``."""
    ps = F.col("processing_state")
    return bucket_items.where(ps.isNull() | (ps != SUBMITTED))


class GateError(RuntimeError):
    pass


def check_gate(bucket_items: DataFrame) -> int:
    """Raise naming one offending item if any item is not ``Submitted`` (F7); else the largest item id (0: none).

    Runs as its own action, before anything is written.
    """
    ps = F.col("processing_state")
    bad = F.min(F.when(ps.isNull() | (ps != SUBMITTED), F.struct("url", "processing_state")))
    row = bucket_items.agg(bad.alias("bad"), F.max("external_item_id").alias("last")).collect()[0]
    if row["bad"] is not None:
        raise GateError(
            f"item processing_state was not '{SUBMITTED}': file={row['bad']['url']} state={row['bad']['processing_state']!r}"
        )
    return int(row["last"] or 0)


def list_sources(bucket_sources: DataFrame, bucket_id: int) -> DataFrame:
    """F9."""
    return bucket_sources.where(F.col("bucket_id") == bucket_id)


def get_source(bucket_sources: DataFrame, external_source_id: int) -> DataFrame:
    """F8."""
    return bucket_sources.where(F.col("external_source_id") == external_source_id)


def delete_sources(bucket_sources: DataFrame, bucket_items: DataFrame, tombstones: DataFrame):
    """Delete sources by id, and their items."""
    ids = tombstones.select(F.col("external_source_id").cast("long").alias("external_source_id")).distinct()
    ids = bounded_broadcast(ids)
    src = bucket_sources.withColumn("_sid", F.col("external_source_id").cast("long"))
    kept_sources = src.join(ids.withColumnRenamed("external_source_id", "_sid"), "_sid", "left_anti").drop("_sid")
    kept_items = bucket_items.join(ids, "external_source_id", "left_anti")
    return kept_sources, kept_items


def delete_items(bucket_items: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Delete items by (source id, item id)."""
    keys = ["external_source_id", "external_item_id"]
    ids = tombstones.select(*[F.col(k).cast("long").alias(k) for k in keys]).distinct()
    return bucket_items.join(bounded_broadcast(ids), keys, "left_anti")


def _check_bucket_id(bucket_id) -> None:
    # The bucket id is a 32-bit signed integer, checked before any write.
    if not isinstance(bucket_id, int) or isinstance(bucket_id, bool) or not (-(2**31) <= bucket_id < 2**31):
        raise ValueError(f"bucket id must be a 32-bit integer, got {bucket_id!r}")
