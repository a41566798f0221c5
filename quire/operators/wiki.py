"""Wiki space exports: paging stop, page cap, page files, last write wins.

Input is the landed paged listing, one row per response batch
(``schemas.CONTENT_BATCHES``).  The reference reads batches one after the
other; here every rule is restated over the whole table so that no source
is ever processed by a single task:

* paging stop (F5) is a per-source minimum over batch rows, plus one
  anti-join that finds the first missing batch;
* page cap (F6) is a filter on the page's ordinal in its source;
* last write wins (W1) is a map-side combined ``max`` per (source, stem), and
  an anti-join that leaves out the overwritten pages.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.naming import page_hierarchy, page_stem
from quire.functions.text import html_to_markdown
from quire.operators.numbering import prefix_sum
from quire.operators.sizing import bounded_broadcast
from quire.operators.stage import land, materialize

# Batch size of the paged listing, page file suffix, space document name.
API_BATCH_SIZE = 100
PAGE_SUFFIX = ".md"
SPACE_DOCUMENT = "space.json"


def parse_page_limit(value: str | None) -> int | None:
    """Page cap from its text form: unset or not an unsigned integer means no cap."""
    if value is None or not re.fullmatch(r"\+?[0-9]+", value):
        return None
    n = int(value)
    return n if n < 2**64 else None


def _batch_view(batches: DataFrame, batch_size: int) -> DataFrame:
    ok_status = F.coalesce(F.col("status").between(200, 299), F.lit(False))  # no status: failed
    return batches.select(
        "source_dir",
        "start",
        (F.col("start") / F.lit(batch_size)).cast("long").alias("k"),
        F.size(F.coalesce(F.col("results"), F.array())).alias("n"),
        (~(ok_status & F.coalesce(F.col("parsed"), F.lit(False)))).alias("failed"),
        "results",
    )


def stop_points(keys: DataFrame, batch_size: int = API_BATCH_SIZE) -> DataFrame:
    """Per source, the index of the batch at which paging ends.

    Paging ends at the first batch that is short (fewer results than the
    batch size), failed (non-2xx status or unparsable body), or missing.
    """
    ended = keys.where(F.col("failed") | (F.col("n") < batch_size)).select("source_dir", "k")
    present = keys.select("source_dir", "k")
    # A batch is missing when its predecessor is present and it is not,
    # or when it is the first batch of a source that has any batch.
    successors = present.select("source_dir", (F.col("k") + 1).alias("k"))
    firsts = present.select("source_dir").distinct().withColumn("k", F.lit(0).cast("long"))
    missing = successors.unionByName(firsts).join(present, ["source_dir", "k"], "left_anti")
    return ended.unionByName(missing).groupBy("source_dir").agg(F.min("k").alias("stop_k"))


def _keep():
    return (F.col("k") < F.col("stop_k")) | ((F.col("k") == F.col("stop_k")) & ~F.col("failed"))


class _Paging:
    """One batch table, landed (or already so), with its small key table and stop points.

    Every decision of the paging rules is taken on the keys; the page
    contents are read again only to emit the kept pages.  A response landed
    more than once (a retry) counts once: the first that did not fail, else
    the first.
    """

    def __init__(self, batches: DataFrame, batch_size: int, page_limit: int | None = None, landed: bool = False):
        self.batch_size = batch_size
        self.page_limit = page_limit
        view = _batch_view(batches, batch_size).withColumn("_row", F.monotonically_increasing_id())
        self.batches = view if landed else land(view, "responses")
        aligned = (F.col("start") >= 0) & (F.col("start") % batch_size == 0)
        self.strays = self.batches.where(~aligned).select("source_dir", "start")
        every = self.batches.where(aligned).select("source_dir", "k", "start", "n", "failed", "_row")
        chosen = F.min_by(F.struct("start", "n", "failed", "_row"), F.struct("failed", "_row"))
        self.keys = materialize(
            every.groupBy("source_dir", "k").agg(chosen.alias("b"), F.count(F.lit(1)).alias("copies")).select("source_dir", "k", "b.*", "copies"),
            "batch-keys",
        )
        repeated = self.keys.where("copies > 1").select("source_dir", "k", F.col("_row").alias("_chosen"))
        losers = every.join(bounded_broadcast(repeated), ["source_dir", "k"]).where("_row <> _chosen").select("_row")
        self.losers = bounded_broadcast(materialize(losers, "retries"))
        self.stops = bounded_broadcast(materialize(stop_points(self.keys, batch_size), "stops"))
        self.oversized = self.keys.where(F.col("n") > batch_size).limit(1).count() > 0

    def kept(self) -> DataFrame:
        b = self.batches.where((F.col("start") >= 0) & (F.col("start") % self.batch_size == 0))
        if self.page_limit is not None:  # a batch's pages never come before its start
            b = b.where(F.col("start") < F.lit(self.page_limit))
        b = b.join(self.losers, "_row", "left_anti").drop("_row")
        return b.join(self.stops, "source_dir").where(_keep()).drop("stop_k")

    def rejects(self) -> DataFrame:
        """Responses that gave no pages: the failed one that ended paging before the cap, and misplaced ones."""
        at = F.concat(F.lit("start="), F.col("start").cast("string")).alias("detail")
        row = lambda reason: ("source_dir", F.lit(None).cast("string").alias("rel_path"), F.lit(reason).alias("reason"), at)
        staged = self.keys.join(self.stops, "source_dir")
        ended = staged.where((F.col("k") == F.col("stop_k")) & F.col("failed"))
        if self.page_limit is not None:
            listed = staged.where(F.col("k") < F.col("stop_k")).groupBy("source_dir").agg(F.sum("n").alias("listed"))
            ended = ended.join(listed, "source_dir", "left").where(F.coalesce("listed", F.lit(0)) < F.lit(self.page_limit))
        return ended.select(*row("page_batch_failed")).unionByName(self.strays.select(*row("page_batch_misplaced")))

    def pages(self) -> DataFrame:
        return cap_pages(pages_of(self.kept(), self.batch_size, self.oversized), self.page_limit)


def kept_batches(batches: DataFrame, batch_size: int = API_BATCH_SIZE) -> DataFrame:
    """Batches before the stop point, plus the stop batch itself when it did not fail."""
    return _Paging(batches, batch_size).kept()


def rejected_batches(batches: DataFrame, batch_size: int = API_BATCH_SIZE, page_limit: int | None = None) -> DataFrame:
    """Reject rows of the responses that gave no pages."""
    return _Paging(batches, batch_size, page_limit).rejects()


def listed_pages(batches: DataFrame, batch_size: int = API_BATCH_SIZE, page_limit: int | None = None, landed: bool = False) -> DataFrame:
    """Pages of the kept batches with their ordinals (S5 + F5), up to the cap.

    ``landed`` says that ``batches`` is a plain scan of stored files, whose
    rows come in the same order each time; they aren't written again then.
    """
    return _Paging(batches, batch_size, page_limit, landed).pages()


def pages_of(kept: DataFrame, batch_size: int = API_BATCH_SIZE, oversized: bool | None = None) -> DataFrame:
    """One row per page of the kept batches, with its 0-based ordinal in the source.

    All kept batches but the last are full, so when none holds more than the
    batch size the ordinal is ``start + pos``.  A batch holding more results
    than asked for shifts later ordinals; then the offsets are an exact
    running sum of batch sizes, computed without a per-source window.
    """
    if oversized is None:
        oversized = kept.where(F.col("n") > batch_size).limit(1).count() > 0
    if oversized:
        offsets = _batch_offsets(kept)
        kept = kept.join(offsets, ["source_dir", "k"])
    else:
        kept = kept.withColumn("offset", F.col("start").cast("long"))
    exploded = kept.select(
        "source_dir", "start", "offset", F.posexplode("results").alias("pos", "page")
    )
    # Extra fields of the page struct (e.g. an id) are carried along.
    return exploded.select(
        "source_dir",
        "start",
        "pos",
        (F.col("offset") + F.col("pos")).alias("ordinal"),
        "page.*",
    ).withColumn("body", F.coalesce(F.col("body.storage.value"), F.lit("")))


def _batch_offsets(kept: DataFrame) -> DataFrame:
    """Exclusive running sum of batch sizes per source, via global numbering."""
    sizes = kept.select("source_dir", "k", "n")
    summed = prefix_sum(sizes, ["source_dir", "k"], "n", "before")
    first = summed.groupBy("source_dir").agg(F.min("before").alias("base"))
    return summed.join(bounded_broadcast(first), "source_dir").select(
        "source_dir", "k", (F.col("before") - F.col("base")).alias("offset")
    )


def cap_pages(pages: DataFrame, limit: int | None) -> DataFrame:
    """First ``limit`` pages of each source in listing order (F6); None keeps all."""
    if limit is None:
        return pages
    return pages.where(F.col("ordinal") < F.lit(limit))


def page_files(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Page rows to file rows: stem from the hierarchy, markdown body."""
    stem = page_stem(page_hierarchy("ancestors", "title"))
    return pages.select(
        "source_dir",
        "ordinal",
        F.concat(stem, F.lit(PAGE_SUFFIX)).alias("rel_path"),
        html_to_markdown("body").alias("markdown"),
        *keep,
    )


def last_write_wins(files: DataFrame, key: str = "rel_path", order: str = "ordinal") -> DataFrame:
    """Keep, per (source_dir, key), the row latest in listing order.

    (source_dir, ``order``) identifies a row.  Only names are aggregated; the
    rows they overwrite are then left out, so contents are not shuffled.
    """
    names = files.select("source_dir", key, order)
    last = names.groupBy("source_dir", key).agg(F.max(order).alias("_last"), F.count(F.lit(1)).alias("_n"))
    repeated = bounded_broadcast(materialize(last.where("_n > 1").drop("_n"), "repeated-names"))
    over = names.join(repeated, ["source_dir", key]).where(F.col(order) < F.col("_last")).select("source_dir", order)
    return files.join(bounded_broadcast(materialize(over, "overwritten")), ["source_dir", order], "left_anti").select(files.columns)


def wiki_files(
    batches: DataFrame,
    spaces: DataFrame | None = None,
    batch_size: int = API_BATCH_SIZE,
    page_limit: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Landed wiki exports to ``files`` rows and rejects: stop, cap, name, overwrite.

    Names keep any length: a table, unlike a file system, has no limit on them.
    ``spaces`` holds one ``(source_dir, body)`` row per space document; it
    becomes the item ``space.json`` of that source (U2).
    """
    paging = _Paging(batches, batch_size, page_limit)
    named = last_write_wins(page_files(paging.pages()))
    files = named.select(
        "source_dir",
        "rel_path",
        F.octet_length("markdown").cast("long").alias("length"),
        F.col("markdown").cast("binary").alias("content"),
    )
    if spaces is not None:
        files = files.unionByName(
            spaces.select(
                "source_dir",
                F.lit(SPACE_DOCUMENT).alias("rel_path"),
                F.octet_length("body").cast("long").alias("length"),
                F.col("body").cast("binary").alias("content"),
            )
        )
    return files, paging.rejects()
