"""Engine inputs derived from the given tables, identically in Spark and in SQL.

* ``documents`` -> repository snapshots: every document is a file of the
  repository named by its ``source``; its path is built from ``doc_id`` so
  that hidden folders, build folders and deep paths all occur.  The first
  short document (fewer than 300 characters) of a source also lands as that
  repository's root ``README.md``.
* ``documents`` -> source catalogue: one repository per ``source`` and one
  wiki space per ``lang`` (these spaces have nothing landed: empty sources).
* ``pages`` -> wiki exports: one space per url host; pages are listed in
  ``page_id`` order in batches; ``?page=`` urls were removed before listing
  (short batches), a batch holding an ``.html`` url came back with status
  503, one where every url ends ``#top`` had an unparsable body.

The SQL twins of these rules live in :mod:`quire.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.naming import git_dir_name, logical_name, source_dir, wiki_dir_name
from quire.operators.numbering import dense_number, rank_within
from quire.operators.stage import land, materialize
from quire.session import staging_path
from quire.sources import landed

# Fixed values of the derivation (mirrored in the SQL).
GIT_HOST = "https://git.example.com/"
DOC_WIKI_HOST = "https://wiki.example.com/"
PAGE_SPACE_KEY = "KB"
README_MAX_CHARS = 300
EPOCH = 1_700_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- documents


def doc_source_dir(source) -> Column:
    return git_dir_name(F.concat(F.lit(GIT_HOST), F.col(source)), F.lit(None).cast("string"))


def doc_rel_path() -> Column:
    doc_id = F.col("doc_id")
    prefix = (
        F.when(doc_id % 11 == 0, F.lit(".git/"))
        .when(doc_id % 11 == 1, F.lit("a/target/"))
        .when(doc_id % 11 == 2, F.lit("targets/"))
        .when(doc_id % 11 == 3, F.lit(".github/"))
        .otherwise(F.lit("src/"))
    )
    segs = F.repeat(F.concat(F.lit("seg"), (doc_id % 7).cast("string"), F.lit("/")), (doc_id % 60).cast("int"))
    base = F.when(doc_id % 13 == 0, F.lit("target")).otherwise(
        F.concat(F.lit("doc_"), doc_id.cast("string"), F.lit(".txt"))
    )
    return F.concat(prefix, segs, base)


def doc_files(documents: DataFrame, with_doc_id: bool = False) -> DataFrame:
    """``files`` rows of the repository snapshots (plus README copies)."""
    extra = [F.col("doc_id")] if with_doc_id else []
    files = documents.select(
        doc_source_dir("source").alias("source_dir"),
        doc_rel_path().alias("rel_path"),
        F.octet_length("text").cast("long").alias("length"),
        F.col("text").cast("binary").alias("content"),
        *extra,
    )
    first_short = (
        documents.where(F.col("n_chars") < README_MAX_CHARS)
        .groupBy("source")
        .agg(F.min_by(F.struct("doc_id", "text"), F.col("doc_id")).alias("d"))
    )
    readmes = first_short.select(
        doc_source_dir("source").alias("source_dir"),
        F.lit("README.md").alias("rel_path"),
        F.octet_length("d.text").cast("long").alias("length"),
        F.col("d.text").cast("binary").alias("content"),
        *([F.col("d.doc_id").alias("doc_id")] if with_doc_id else []),
    )
    return files.unionByName(readmes)


def modified_at() -> Column:
    """A time for each document: sources change in seasons of their own."""
    days = F.ascii(F.right(F.col("source"), F.lit(1))) % 5 * 100 + F.col("doc_id") % 97
    return F.timestamp_seconds(F.lit(EPOCH) + days * 86400)


def timed_files(documents: DataFrame) -> DataFrame:
    """:func:`doc_files` without README copies, with the time each was modified."""
    return documents.select(
        doc_source_dir("source").alias("source_dir"),
        doc_rel_path().alias("rel_path"),
        F.octet_length("text").cast("long").alias("length"),
        F.col("text").cast("binary").alias("content"),
        modified_at().alias("modified"),
    )


def deep_files(documents: DataFrame) -> DataFrame:
    """Files so deep that their names lose their folders, which then collide."""
    rel = F.concat(F.lit("pkg"), F.col("doc_id").cast("string"), F.lit("/" + "a_folder_of_some_depth/" * 3), F.repeat(F.lit("x"), F.lit(190)), F.lit("/file"), (F.col("doc_id") % 20).cast("string"), F.lit(".txt"))
    return documents.select(
        doc_source_dir("source").alias("source_dir"),
        rel.alias("rel_path"),
        F.octet_length("text").cast("long").alias("length"),
        F.col("text").cast("binary").alias("content"),
    )


def doc_links(documents: DataFrame) -> DataFrame:
    """Links in every repository (F2): to its first plain file, to nothing, to itself (a loop), and to a hidden folder."""
    first = documents.where(F.col("doc_id") % 11 > 3).groupBy("source").agg(F.min("doc_id").alias("doc_id"))
    kinds = F.array(
        *(F.struct(F.lit(at).alias("rel_path"), to.alias("to")) for at, to in (
            ("links/first", F.concat(F.lit("../"), doc_rel_path())), ("links/gone", F.lit("../no/such/file")), ("links/up", F.lit(".."))
        ))
    )
    return first.select(doc_source_dir("source").alias("source_dir"), F.explode(kinds).alias("k")).select("source_dir", "k.*")


def catalogue_files(documents: DataFrame) -> str:
    """The catalogue of :func:`doc_sources` as landed JSON: one array a type, in the order of the addresses; returns the files' glob."""
    record = F.struct("type", "repo_url", "reference", "base_url", "space_key")
    ordered = F.sort_array(F.collect_list(F.struct(F.coalesce("repo_url", "base_url").alias("address"), record.alias("record"))))
    arrays = doc_sources(documents).groupBy("type").agg(F.to_json(F.transform(ordered, lambda x: x["record"])).alias("value"))  # configuration-sized
    path = staging_path(documents.sparkSession, "catalogue")
    arrays.withColumn("file", F.col("type")).select("value", "file").coalesce(1).write.partitionBy("file").text(path)
    return f"{path}/*/*.txt"


def landed_responses(pages: DataFrame, batch_size: int) -> DataFrame:
    """:func:`whole_responses` landed as several JSON files and read as such."""
    path = staging_path(pages.sparkSession, "responses")
    whole_responses(pages, batch_size).write.json(path)
    return landed.read_responses(pages.sparkSession, path)


def doc_catalogue(documents: DataFrame) -> DataFrame:
    """Source catalogue (S1 shape + source_dir, pos): repositories and empty spaces."""
    return numbered_catalogue(doc_sources(documents))


def doc_sources(documents: DataFrame) -> DataFrame:
    """Unnumbered catalogue rows of :func:`doc_catalogue`."""
    null = F.lit(None).cast("string")
    repos = documents.select("source").distinct().select(
        F.lit("git").alias("type"),
        F.concat(F.lit(GIT_HOST), F.col("source")).alias("repo_url"),
        null.alias("reference"),
        null.alias("base_url"),
        null.alias("space_key"),
    )
    spaces = documents.select("lang").distinct().select(
        F.lit("confluence").alias("type"),
        null.alias("repo_url"),
        null.alias("reference"),
        F.concat(F.lit(DOC_WIKI_HOST), F.col("lang"), F.lit("/")).alias("base_url"),
        F.upper("lang").alias("space_key"),
    )
    return repos.unionByName(spaces)


def numbered_catalogue(cat: DataFrame) -> DataFrame:
    """Catalogue rows + ``source_dir``, ``logical_name`` and ``pos`` in folder-name order."""
    cat = cat.withColumn(
        "source_dir", source_dir("type", "repo_url", "reference", "base_url", "space_key")
    ).withColumn("logical_name", logical_name("type", "repo_url", "base_url", "space_key"))
    numbered = dense_number(cat, ["source_dir"], "pos").withColumn("pos", F.col("pos").cast("int"))
    return materialize(numbered, "catalogue")


def manifest_of(catalogue: DataFrame) -> DataFrame:
    return catalogue.select("pos", "logical_name", "source_dir", "type")


# -------------------------------------------------------------------- pages


def clean_url(url="url") -> Column:
    return F.regexp_replace(F.col(url), "[?#].*$", "")


def url_host(url="url") -> Column:
    return F.split_part(F.split_part(clean_url(url), F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))


def url_segments(url="url") -> Column:
    """Path segments after the host (may end with an empty segment)."""
    parts = F.split(F.split_part(clean_url(url), F.lit("://"), F.lit(2)), "/")
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def page_source_dir(url="url") -> Column:
    return wiki_dir_name(F.concat(F.lit("https://"), url_host(url), F.lit("/wiki")), F.lit(PAGE_SPACE_KEY))


def page_title(html="html") -> Column:
    return F.nullif(F.regexp_extract(F.col(html), "<title>(.*?)</title>", 1), F.lit(""))


def page_ancestors(url="url") -> Column:
    segs = url_segments(url)
    above = F.slice(segs, 1, F.greatest(F.size(segs) - 1, F.lit(0)))
    return F.transform(
        above,
        lambda s: F.struct(F.when(s.rlike("^[0-9]+$"), F.lit(None)).otherwise(s).cast("string").alias("title")),
    )


def wiki_pages(pages: DataFrame) -> DataFrame:
    """Pages with their space folder, title and ancestors (before listing)."""
    return pages.select(
        "page_id",
        "url",
        page_source_dir().alias("source_dir"),
        page_title().alias("title"),
        page_ancestors().alias("ancestors"),
        F.col("html").alias("body"),
    )


def page_catalogue(pages: DataFrame) -> DataFrame:
    """Catalogue of one wiki space per url host (numbered)."""
    return numbered_catalogue(page_sources(pages))


def page_sources(pages: DataFrame) -> DataFrame:
    """Unnumbered catalogue rows of :func:`page_catalogue`."""
    null = F.lit(None).cast("string")
    spaces = pages.select(url_host().alias("host")).distinct().select(
        F.lit("confluence").alias("type"),
        null.alias("repo_url"),
        null.alias("reference"),
        F.concat(F.lit("https://"), F.col("host"), F.lit("/wiki")).alias("base_url"),
        F.lit(PAGE_SPACE_KEY).alias("space_key"),
    )
    return spaces


def page_batches(pages: DataFrame, batch_size: int) -> DataFrame:
    """Landed listing responses (``schemas.CONTENT_BATCHES`` + page ``id``)."""
    ranked = rank_within(wiki_pages(pages), ["source_dir"], ["page_id"], "p")
    listed = ranked.where(~F.col("url").contains("?page="))
    page = F.struct(
        F.col("title"),
        F.struct(F.struct(F.col("body").alias("value")).alias("storage")).alias("body"),
        F.col("ancestors"),
        F.col("page_id").alias("id"),
        F.col("url"),
    )
    start = (F.floor(F.col("p") / batch_size) * batch_size).cast("int")
    grouped = listed.groupBy("source_dir", start.alias("start")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("p"), page.alias("page")))).alias("lst"),
        F.max(F.col("url").contains(".html")).alias("bad_status"),
        F.min(F.col("url").endswith("#top")).alias("bad_body"),
    )
    landed = grouped.select(
        "source_dir",
        "start",
        F.when(F.col("bad_status"), F.lit(503)).otherwise(F.lit(200)).alias("status"),
        (~F.col("bad_body")).alias("parsed"),
        F.transform("lst", lambda x: x["page"]).alias("results"),
    )
    # Landed once as parquet, like real landed responses.
    return land(landed, "batches")


def whole_listing(pages: DataFrame, batch_size: int) -> DataFrame:
    """One row per page of listings in which no page is missing and no response failed: source_dir, start, p, page.

    Pages of ``?page=`` urls came without a body.
    """
    ranked = rank_within(wiki_pages(pages), ["source_dir"], ["page_id"], "p")
    body = F.when(~F.col("url").contains("?page="), F.struct(F.struct(F.col("body").alias("value")).alias("storage")))
    page = F.struct("title", body.alias("body"), "ancestors", F.col("page_id").alias("id"), "url")
    return ranked.select("source_dir", (F.floor(F.col("p") / batch_size) * batch_size).cast("int").alias("start"), "p", page.alias("page"))


def whole_batches(pages: DataFrame, batch_size: int) -> DataFrame:
    """:func:`whole_listing` as parsed responses, the pages with their ``id`` and ``url``."""
    listed = F.sort_array(F.collect_list(F.struct("p", "page")))
    grouped = whole_listing(pages, batch_size).groupBy("source_dir", "start").agg(listed.alias("lst"))
    return grouped.select(
        "source_dir", "start", F.lit(200).alias("status"), F.lit(True).alias("parsed"), F.transform("lst", lambda x: x["page"]).alias("results")
    )


def whole_responses(pages: DataFrame, batch_size: int) -> DataFrame:
    """The same listings and the space documents as landed text (``schemas.LANDED_RESPONSES``); unset fields are missing from it."""
    listing = whole_batches(pages, batch_size).select("source_dir", "start", "status", F.to_json(F.struct("results")).alias("body"))
    spaces = page_spaces(pages).select("source_dir", F.lit(None).cast("int").alias("start"), F.lit(200).alias("status"), "body")
    return listing.unionByName(spaces)


def page_spaces(pages: DataFrame) -> DataFrame:
    """One landed space document per space (becomes ``space.json``)."""
    hosts = pages.select(url_host().alias("host"), page_source_dir().alias("source_dir")).distinct()
    return hosts.select(
        "source_dir",
        F.concat(F.lit('{"key":"' + PAGE_SPACE_KEY + '","name":"'), F.col("host"), F.lit('"}')).alias("body"),
    )


# ------------------------------------------------------------ mixed catalog


def page_source_rows(pages: DataFrame) -> DataFrame:
    """One configured source per page row (source naming queries).

    http urls are repositories (reference = the url fragment, else default);
    https urls are wiki spaces (base url = the cleaned url, trailing '/' kept;
    key = first path segment, upper-cased).
    """
    cleaned = clean_url()
    is_git = F.col("url").startswith("http:")
    null = F.lit(None).cast("string")
    return pages.select(
        F.col("page_id").cast("int").alias("pos"),
        F.when(is_git, F.lit("git")).otherwise(F.lit("confluence")).alias("type"),
        F.when(is_git, cleaned).otherwise(null).alias("repo_url"),
        F.when(is_git, F.nullif(F.regexp_extract("url", "#(.*)$", 1), F.lit(""))).otherwise(null).alias("reference"),
        F.when(~is_git, cleaned).otherwise(null).alias("base_url"),
        F.when(~is_git, F.upper(F.try_element_at(url_segments(), F.lit(1)))).otherwise(null).alias("space_key"),
        F.try_element_at(url_segments(), F.lit(1)).alias("lang"),
    )


def previous_doc_files(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """An older snapshot of the repositories, for snapshot comparison.

    Before: toxic documents were not there yet, low-quality ones carried a
    draft note, no README had landed, and every repository had a CHANGELOG.md.
    """
    from quire.operators.sizing import bounded_broadcast

    lab = bounded_broadcast(labels.select("doc_id", "quality", "toxic"))
    files = doc_files(documents.join(lab, "doc_id", "left").where(F.coalesce(F.col("toxic"), F.lit(0)) != 1)
                      .withColumn("text", F.when(F.col("quality") == 0, F.concat("text", F.lit("\n(draft)")))
                                  .otherwise(F.col("text"))), with_doc_id=True)
    files = files.where(F.col("rel_path") != "README.md").drop("doc_id")
    changelog = documents.select("source").distinct().select(
        doc_source_dir("source").alias("source_dir"),
        F.lit("CHANGELOG.md").alias("rel_path"),
        F.concat(F.lit("changes of "), F.col("source")).alias("t"),
    ).select("source_dir", "rel_path", F.octet_length("t").cast("long").alias("length"), F.col("t").cast("binary").alias("content"))
    return files.unionByName(changelog)
