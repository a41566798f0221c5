"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (or data Spark derives from them) whole.
The DuckDB twins of these queries are in :mod:`quire.plans.oracle`.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.functions.naming import (
    logical_name,
    page_hierarchy,
    page_stem,
    processor_kind,
    source_dir,
)
from quire.functions.naming import READMETOPDF_KINDS, FLATTEN_KINDS
from quire.functions.text import html_to_markdown, lossy_utf8
from quire.operators import audit, bucket, process, report, wiki
from quire.operators.sizing import bounded_broadcast
from quire.operators.stage import land
from quire.operators.store import DedupStore, TableStore
from quire.plans import derive, sync
from quire.plans.derive import table
from quire.session import staging_path
from quire.sources import catalogue, landed, snapshot, treescan
from quire.streaming import incremental

# Query parameters (mirrored in the SQL).
BUCKET_ID = 7
OTHER_BUCKET_ID = 8
WIKI_BATCH = 2
PAGE_CAP = 3
REPORT_PART = 20
SINCE_DAYS = 350
LANDING = "/shared/landing"

Query = Callable[[SparkSession, str], DataFrame]


def _long(c):
    return F.col(c).cast("long") if isinstance(c, str) else c.cast("long")


# ------------------------------------------------------------- catalogue


def q_source_dir_names(spark, sf) -> DataFrame:
    s = derive.page_source_rows(table(spark, sf, "pages"))
    return s.select(
        _long("pos").alias("pos"),
        "type",
        source_dir("type", "repo_url", "reference", "base_url", "space_key").alias("source_dir"),
    )


KIND_BY_LANG = {"en": "FlattenFiles", "fr": "readme2pdf", "de": "flatten_files", "es": "ReadmeToPdf"}


def q_source_manifest(spark, sf) -> DataFrame:
    s = derive.page_source_rows(table(spark, sf, "pages"))
    kind = F.coalesce(
        *[F.when(F.col("lang") == k, F.lit(v)) for k, v in KIND_BY_LANG.items()], F.col("lang")
    )
    return s.select(
        _long("pos").alias("pos"),
        "type",
        logical_name("type", "repo_url", "base_url", "space_key").alias("logical_name"),
        source_dir("type", "repo_url", "reference", "base_url", "space_key").alias("source_dir"),
        "repo_url",
        F.coalesce("reference", F.lit("main")).alias("reference"),
        "base_url",
        "space_key",
        processor_kind(kind).alias("processor"),
        F.coalesce(kind.isin(*READMETOPDF_KINDS, *FLATTEN_KINDS), F.lit(False)).alias("kind_known"),
    )


def q_catalogue_manifest(spark, sf) -> DataFrame:
    """The catalogue read from landed JSON files, and its manifest with the original records."""
    sources = catalogue.read_sources(spark, derive.catalogue_files(table(spark, sf, "documents")))
    bad = catalogue.invalid_sources(sources).count()
    if bad:
        raise ValueError(f"{bad} invalid sources")
    return catalogue.manifest(sources, LANDING).select(
        _long("pos").alias("pos"), "type", "logical_name", "source_dir", "local_path", F.col("original_source.repo_url").alias("repo_url"), F.col("original_source.space_key").alias("space_key")
    )


# ------------------------------------------------------ repository items


def _doc_inputs(spark, sf, with_doc_id=False):
    docs = table(spark, sf, "documents")
    cat = derive.doc_catalogue(docs)
    return docs, derive.doc_files(docs, with_doc_id), derive.manifest_of(cat)


def q_flatten_items(spark, sf) -> DataFrame:
    _, files, manifest = _doc_inputs(spark, sf)
    items, _ = process.flatten_files(files, manifest)
    return items.select(
        _long("pos").alias("pos"),
        "source_name",
        "rel_path",
        "filename",
        F.octet_length("content").cast("long").alias("n_bytes"),
    )


def q_readme_items(spark, sf) -> DataFrame:
    _, files, manifest = _doc_inputs(spark, sf)
    items, _ = process.readme_files(files, manifest)
    return items.select(
        "source_dir",
        "source_name",
        "filename",
        F.octet_length("content").cast("long").alias("pdf_bytes"),
        F.substring(F.col("content"), 1, 4).cast("string").alias("pdf_magic"),
        F.octet_length("source_text").cast("long").alias("readme_bytes"),
    )


def q_missing_readme(spark, sf) -> DataFrame:
    _, files, manifest = _doc_inputs(spark, sf)
    return process.missing_readme(files, manifest).select("source_dir", "reason", "detail")


def q_flat_name_collisions(spark, sf) -> DataFrame:
    _, files, manifest = _doc_inputs(spark, sf)
    items, _ = process.flatten_files(files, manifest)
    return audit.flat_name_collisions(items).select(_long("pos").alias("pos"), "filename", "n")


def q_deep_name_collisions(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents")
    items, _ = process.flatten_files(derive.deep_files(docs), derive.manifest_of(derive.doc_catalogue(docs)))
    return audit.flat_name_collisions(items).select(_long("pos").alias("pos"), "filename", "n")


# -------------------------------------------------------------- wiki pages


def q_html_to_markdown(spark, sf) -> DataFrame:
    pages = table(spark, sf, "pages")
    return pages.select("page_id", html_to_markdown("html").alias("markdown"))


def q_page_stems(spark, sf) -> DataFrame:
    p = derive.wiki_pages(table(spark, sf, "pages"))
    stem = page_stem(page_hierarchy("ancestors", "title"))
    return p.select("page_id", "source_dir", stem.alias("stem"), F.concat(stem, F.lit(".md")).alias("filename"))


def _kept_pages(spark, sf, batch=WIKI_BATCH, page_limit=None):
    batches = derive.page_batches(table(spark, sf, "pages"), batch)
    return wiki.listed_pages(batches, batch, page_limit, landed=True)


def q_paging_stop(spark, sf) -> DataFrame:
    pages = _kept_pages(spark, sf)
    return pages.select("source_dir", _long("start").alias("start"), _long("pos").alias("pos"), F.col("id").alias("page_id"))


def q_page_cap(spark, sf) -> DataFrame:
    pages = _kept_pages(spark, sf, page_limit=PAGE_CAP)
    return pages.select("source_dir", _long("start").alias("start"), _long("pos").alias("pos"), F.col("id").alias("page_id"))


def q_last_write_wins(spark, sf) -> DataFrame:
    raw = table(spark, sf, "pages")
    pages = wiki.listed_pages(derive.whole_batches(raw, WIKI_BATCH), WIKI_BATCH)
    # Name every page after the first segment of its url, so pages collide.
    lang = F.try_element_at(derive.url_segments("url"), F.lit(1))
    renamed = pages.withColumn("title", lang).withColumn("ancestors", F.array().cast("array<struct<title:string>>"))
    files = wiki.last_write_wins(wiki.page_files(renamed, keep=("id",)))
    winners = files.select(
        "source_dir", "rel_path", F.col("id").alias("page_id"), F.octet_length("markdown").cast("long").alias("n_bytes")
    )
    spaces = derive.page_spaces(raw).select(
        "source_dir",
        F.lit(wiki.SPACE_DOCUMENT).alias("rel_path"),
        F.lit(None).cast("long").alias("page_id"),
        F.octet_length("body").cast("long").alias("n_bytes"),
    )
    return winners.unionByName(spaces)


def q_space_failures(spark, sf) -> DataFrame:
    """Space documents whose response failed, of hosts with an even number of letters, or had no status."""
    size = F.length("source_dir")
    status = F.when(size % 2 == 0, F.lit(503)).when(size % 3 > 0, F.lit(200))
    spaces = derive.page_spaces(table(spark, sf, "pages")).select("source_dir", status.alias("status"), "body")
    return landed.failed_spaces(spaces)


# ------------------------------------------------------------------ bucket


def _doc_load(spark, sf):
    """Repository items of the documents and their sources created in bucket 7."""
    docs, files, manifest = _doc_inputs(spark, sf)
    items, _ = process.flatten_files(files, manifest)
    srcs = bucket.load_sources(manifest, BUCKET_ID)
    return docs, items, srcs


def q_bucket_sources_load(spark, sf) -> DataFrame:
    _, _, srcs = _doc_load(spark, sf)
    return bucket.source_table(srcs)


def q_bucket_items_load(spark, sf) -> DataFrame:
    _, items, srcs = _doc_load(spark, sf)
    return bucket.load_items(items, srcs)


def _labelled_load(spark, sf, backend_state_from_labels=False, with_content=False):
    """Documents loaded into bucket 7, items carrying ``doc_id`` and the document's labels."""
    _, files, manifest = _doc_inputs(spark, sf, with_doc_id=True)
    labels = bounded_broadcast(table(spark, sf, "labels").select("doc_id", "quality", "toxic"))
    items, _ = process.flatten_files(files, manifest, keep=("doc_id",))
    items = items.join(labels, "doc_id", "left")
    srcs = bucket.load_sources(manifest, BUCKET_ID)
    state = F.when(F.col("toxic") == 1, F.lit("Failed")) if backend_state_from_labels else None
    loaded = bucket.load_items(items, srcs, backend_state=state, keep=("doc_id", "quality", "toxic"), with_content=with_content)
    # The loaded bucket, as the store would hold it: later steps read it, not its lineage.
    return manifest, srcs, land(loaded, "bucket")


def q_state_gate(spark, sf) -> DataFrame:
    # The backend refuses toxic documents: it reports them 'Failed'.
    _, _, loaded = _labelled_load(spark, sf, backend_state_from_labels=True)
    return bucket.gate_violations(loaded).select("external_item_id", "url", "processing_state")


def _two_buckets(spark, sf) -> TableStore:
    """Documents' sources stored in bucket 7, page spaces in bucket 8 (ids after bucket 7's)."""
    _, _, manifest = _doc_inputs(spark, sf)
    pages = derive.manifest_of(derive.page_catalogue(table(spark, sf, "pages")))
    store = _scratch_store(spark)
    no_items = spark.createDataFrame([], schemas.STORED_ITEMS)
    for bucket_id, own in ((BUCKET_ID, manifest), (OTHER_BUCKET_ID, pages)):
        base, last_item = store.last_ids()
        srcs = bucket.load_sources(own, bucket_id, id_base=base)
        store.replace(bucket_id, srcs.drop("pos"), no_items, (base + srcs.count(), last_item))
    return store


def q_bucket_list(spark, sf) -> DataFrame:
    listed = _two_buckets(spark, sf).sources(OTHER_BUCKET_ID)
    return listed.select("bucket_id", "external_source_id", "external_source_name")


def q_bucket_get(spark, sf) -> DataFrame:
    found = _two_buckets(spark, sf).source(BUCKET_ID, 3)
    return found.select("bucket_id", "external_source_id", "external_source_name")


def q_bucket_delete_source(spark, sf) -> DataFrame:
    _, srcs, loaded = _labelled_load(spark, sf)
    sources = bucket.source_table(srcs)
    # Tombstones: sources without items, and sources holding a low-quality toxic document.
    counts = report.items_per_source(sources, loaded)
    empty = counts.where(F.col("n_items") == 0).select(F.col("source_id").alias("external_source_id"))
    flagged = loaded.where((F.col("quality") == 0) & (F.col("toxic") == 1)).select("external_source_id")
    kept_sources, kept_items = bucket.delete_sources(sources, loaded, empty.unionByName(flagged))
    return report.items_per_source(kept_sources, kept_items)


def q_bucket_delete_item(spark, sf) -> DataFrame:
    _, _, loaded = _labelled_load(spark, sf)
    # Tombstones: the items of toxic documents.
    tomb = loaded.where(F.col("toxic") == 1).select("external_source_id", "external_item_id")
    kept = bucket.delete_items(loaded, tomb)
    return kept.select("external_source_id", "external_item_id", "url", "content_hash")


def _scratch_store(spark, kind: type[TableStore] = TableStore) -> TableStore:
    """A store under the checkpoint folder, in tables of its own, which go with the session."""
    tag = uuid.uuid4().hex
    store = kind(spark, f"quire_sources_{tag}", f"quire_items_{tag}")
    store.ensure(staging_path(spark, "bucket"))
    return store


def q_refresh_replace(spark, sf) -> DataFrame:
    """Buckets 7 and 8 filled by the full refresh, then 7 again with READMEs alone: the item table afterwards."""
    _, files, manifest = _doc_inputs(spark, sf)
    store = _scratch_store(spark)
    for bucket_id, kind in ((BUCKET_ID, "FlattenFiles"), (OTHER_BUCKET_ID, "FlattenFiles"), (BUCKET_ID, "ReadmeToPDF")):
        # Repositories without a README are rejects of the last refresh.
        sync.synchronise(spark, files, manifest, bucket_id, kind, strict=False, store=store)
    both = store.items(BUCKET_ID).unionByName(store.items(OTHER_BUCKET_ID))
    return both.select("bucket_id", "external_source_id", "external_item_id", "url", "content_hash")


def q_incremental_ids(spark, sf) -> DataFrame:
    """The previous snapshots loaded, then the current ones by the incremental refresh: every item and its id."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    manifest = derive.manifest_of(derive.doc_catalogue(docs))
    store = _scratch_store(spark)
    for files in (derive.previous_doc_files(docs, labels), derive.doc_files(docs)):
        incremental.refresh_sources(spark, files, manifest, BUCKET_ID, "", "", store=store)
    return store.stored_items(BUCKET_ID).select("external_source_id", "external_item_id", "source_dir", "rel_path", "content_hash")


def q_items_per_source(spark, sf) -> DataFrame:
    _, items, srcs = _doc_load(spark, sf)
    # Counting needs no item ids.
    of_source = items.select("pos").join(bounded_broadcast(srcs.select("pos", "external_source_id")), "pos")
    return report.items_per_source(bucket.source_table(srcs), of_source)


def q_sync_report(spark, sf) -> DataFrame:
    _, items, srcs = _doc_load(spark, sf)
    loaded = land(bucket.load_items(items, srcs, with_content=False), "bucket")
    return report.report_rows(bucket.source_table(srcs), loaded)


def q_sync_report_nested(spark, sf) -> DataFrame:
    """The nested report in parts of REPORT_PART ids; lists as JSON, which any client compares alike."""
    _, items, srcs = _doc_load(spark, sf)
    loaded = land(bucket.load_items(items, srcs, with_content=False), "bucket")
    nested = report.sync_report(bucket.source_table(srcs), loaded, part_items=REPORT_PART)
    return nested.select("source_id", "source_name", "part", F.to_json("items").alias("items"))


def q_mixed_sources(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents")
    pages = table(spark, sf, "pages")
    repos = derive.doc_sources(docs).where(F.col("type") == "git")
    cat = derive.numbered_catalogue(repos.unionByName(derive.page_sources(pages)))
    # Every page of every space, through the reader of landed responses.
    responses = derive.landed_responses(pages, WIKI_BATCH)
    spaces = landed.space_documents(responses)
    landed.check_spaces(spaces)
    wfiles, _ = wiki.wiki_files(landed.content_batches(responses), spaces, WIKI_BATCH)
    files = derive.doc_files(docs).unionByName(wfiles)
    items, _ = process.flatten_files(files, derive.manifest_of(cat))
    return items.select(
        _long("pos").alias("pos"),
        "source_name",
        "filename",
        F.octet_length("content").cast("long").alias("n_bytes"),
    )


# ------------------------------------------------------------------- audit


def q_snapshot_replace(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels")
    previous = derive.previous_doc_files(docs, labels)
    current = derive.doc_files(docs, with_doc_id=True)
    # Re-snapshot the repositories holding a document labelled both low-quality and toxic.
    flagged = labels.where((F.col("toxic") == 1) & (F.col("quality") == 0)).select("doc_id")
    refreshed = current.join(flagged, "doc_id", "left_semi").select("source_dir").distinct()
    name, path = f"quire_{uuid.uuid4().hex}", staging_path(spark, "table")
    snapshot.ensure_snapshot_table(spark, name, path)
    snapshot.replace_snapshots(spark, name, previous, previous.select("source_dir").distinct())
    snapshot.replace_snapshots(spark, name, current.drop("doc_id"), refreshed)
    result = snapshot.read_snapshots(spark, name)
    return result.select("source_dir", "rel_path", F.sha2(F.col("content"), 256).alias("content_hash"))


def q_dedup_exact(spark, sf) -> DataFrame:
    _, items, srcs = _doc_load(spark, sf)
    loaded = bucket.load_items(items, srcs, with_content=False)
    return audit.dedup_exact(loaded).select("content_hash", "external_source_id", "external_item_id")


def q_content_store(spark, sf) -> DataFrame:
    """The full refresh with contents stored once: every content and how many items refer to it."""
    _, files, manifest = _doc_inputs(spark, sf)
    store = _scratch_store(spark, DedupStore)
    sync.synchronise(spark, files, manifest, BUCKET_ID, store=store)
    used = store.references(BUCKET_ID).groupBy("content_hash").agg(F.count("*").alias("n_items"))
    held = store.contents(BUCKET_ID)
    sizes = held.select(F.sha2("content", 256).alias("content_hash"), F.octet_length("content").cast("long").alias("n_bytes"))
    return sizes.join(used, "content_hash", "full")


def q_recently_modified(spark, sf) -> DataFrame:
    """Files of the stored snapshots changed since a day; folders without any aren't read."""
    docs = table(spark, sf, "documents")
    name = f"quire_{uuid.uuid4().hex}"
    snapshot.ensure_snapshot_table(spark, name, staging_path(spark, "table"))
    files = derive.timed_files(docs)
    snapshot.replace_snapshots(spark, name, files, files.select("source_dir").distinct())
    since = datetime.datetime.fromtimestamp(derive.EPOCH + SINCE_DAYS * 86400, datetime.UTC)
    return snapshot.recent_files(spark, name, since).select("source_dir", "rel_path", "length", F.unix_timestamp("modified").alias("modified"))


def q_snapshot_diff(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels")
    current = derive.doc_files(docs)
    previous = derive.previous_doc_files(docs, labels)
    return audit.snapshot_diff(previous, current)


def q_checksum_audit(spark, sf) -> DataFrame:
    _, _, loaded = _labelled_load(spark, sf, with_content=True)
    # The stored copy of low-quality documents was altered after the load.
    altered = F.coalesce(F.col("quality") == 0, F.lit(False))
    stored = loaded.withColumn("content", F.when(altered, F.concat("content", F.lit(" "))).otherwise(F.col("content")))
    return audit.checksum_audit(stored).select("external_source_id", "external_item_id", "url", "ok")


def q_lossy_text(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents")
    # A byte that never occurs in UTF-8 half way, and a sequence cut short at the end.
    half = F.floor(F.length("text") / 2).cast("int")
    left, right = F.substring(F.col("text"), F.lit(1), half), F.substring(F.col("text"), half + 1, F.length("text"))
    raw = F.concat(left.cast("binary"), F.lit(bytearray(b"\xff")), right.cast("binary"), F.lit(bytearray(b"\xe2\x82")))
    text = lossy_utf8(raw)
    return docs.select(
        "doc_id",
        text.alias("text"),
        (F.length(text) - F.length(F.replace(text, F.lit("�"), F.lit("")))).cast("long").alias("n_replaced"),
    )


def q_tree_scan(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents")
    root = treescan.land_tree(derive.doc_files(docs, with_doc_id=True))
    files = treescan.read_tree(spark, root)
    return files.select("source_dir", "rel_path", "length", F.sha2("content", 256).alias("content_hash"))


def q_tree_links(spark, sf) -> DataFrame:
    """A landed tree with links: to a file (read), to nothing (skipped), to a folder above (not entered again)."""
    docs = table(spark, sf, "documents")
    root = treescan.land_tree(derive.doc_files(docs, with_doc_id=True))
    treescan.land_links(root, derive.doc_links(docs))
    files = treescan.read_tree(spark, root)
    return files.select("source_dir", "rel_path", "length", F.sha2("content", 256).alias("content_hash"))


QUERIES: dict[str, Query] = {
    "source_dir_names": q_source_dir_names,
    "source_manifest": q_source_manifest,
    "flatten_items": q_flatten_items,
    "readme_items": q_readme_items,
    "missing_readme": q_missing_readme,
    "html_to_markdown": q_html_to_markdown,
    "page_stems": q_page_stems,
    "paging_stop": q_paging_stop,
    "page_cap": q_page_cap,
    "last_write_wins": q_last_write_wins,
    "bucket_sources_load": q_bucket_sources_load,
    "bucket_items_load": q_bucket_items_load,
    "state_gate": q_state_gate,
    "bucket_list": q_bucket_list,
    "bucket_get": q_bucket_get,
    "bucket_delete_source": q_bucket_delete_source,
    "bucket_delete_item": q_bucket_delete_item,
    "refresh_replace": q_refresh_replace,
    "items_per_source": q_items_per_source,
    "sync_report": q_sync_report,
    "sync_report_nested": q_sync_report_nested,
    "incremental_ids": q_incremental_ids,
    "mixed_sources": q_mixed_sources,
    "flat_name_collisions": q_flat_name_collisions,
    "snapshot_diff": q_snapshot_diff,
    "snapshot_replace": q_snapshot_replace,
    "dedup_exact": q_dedup_exact,
    "checksum_audit": q_checksum_audit,
    "lossy_text": q_lossy_text,
    "tree_scan": q_tree_scan,
    "tree_links": q_tree_links,
    "catalogue_manifest": q_catalogue_manifest,
    "deep_name_collisions": q_deep_name_collisions,
    "space_failures": q_space_failures,
    "content_store": q_content_store,
    "recently_modified": q_recently_modified,
}
