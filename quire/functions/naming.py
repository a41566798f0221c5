"""Names of snapshot folders, sources, flat items and wiki pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results.
DEFAULT_REFERENCE = "main"
GIT_DIR_PREFIX = "git_"
WIKI_DIR_PREFIX = "confluence_"
DIR_NAME_UNSAFE = "/:"  # each replaced by "_" in folder names
FLAT_SEPARATOR = "__"
FLAT_NAME_MAX_BYTES = 180
PRUNED_DIRS = (".git", "target")
PAGE_UNSAFE = '/\\:*?"<>|'  # each replaced by "_" in page stems
PAGE_STEM_STRIP = "_."  # stripped from both ends of a page stem
UNTITLED = "untitled"
READMETOPDF_KINDS = ("ReadmeToPDF", "readme_to_pdf", "readme2pdf")
FLATTEN_KINDS = ("FlattenFiles", "flattenfiles", "flatten_files")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim_trailing_slashes(url) -> Column:
    """All trailing '/' removed (P5)."""
    return F.regexp_replace(_c(url), "/+$", "")


def git_dir_name(repo_url, reference) -> Column:
    """Snapshot folder of a repository at a reference."""
    ref = F.coalesce(_c(reference), F.lit(DEFAULT_REFERENCE))
    raw = F.concat(F.lit(GIT_DIR_PREFIX), _c(repo_url), F.lit("_"), ref)
    return F.translate(raw, DIR_NAME_UNSAFE, "_" * len(DIR_NAME_UNSAFE))


def wiki_dir_name(base_url, space_key) -> Column:
    """Snapshot folder of a wiki space (P2); the base url is trimmed first (P5)."""
    raw = F.concat(F.lit(WIKI_DIR_PREFIX), trim_trailing_slashes(base_url), F.lit("_"), _c(space_key))
    return F.translate(raw, DIR_NAME_UNSAFE, "_" * len(DIR_NAME_UNSAFE))


def source_dir(type_, repo_url, reference, base_url, space_key) -> Column:
    t = _c(type_)
    return (
        F.when(t == "git", git_dir_name(repo_url, reference))
        .when(t == "confluence", wiki_dir_name(base_url, space_key))
        # A type of a registered reader is named like a repository, by its own type.
        .otherwise(F.translate(F.concat_ws("_", t, _c(repo_url), F.coalesce(_c(reference), F.lit(DEFAULT_REFERENCE))), DIR_NAME_UNSAFE, "_" * len(DIR_NAME_UNSAFE)))
    )


def logical_name(type_, repo_url, base_url, space_key) -> Column:
    """Human name of a source (P3): the repo url, or ``base_url:space_key`` untrimmed."""
    t = _c(type_)
    return (
        F.when(t == "confluence", F.concat(_c(base_url), F.lit(":"), _c(space_key))).otherwise(_c(repo_url))
    )


def processor_kind(kind) -> Column:
    """Canonical processor (P16); unknown spellings fall back to FlattenFiles."""
    return F.when(_c(kind).isin(*READMETOPDF_KINDS), F.lit("ReadmeToPDF")).otherwise(
        F.lit("FlattenFiles")
    )


def in_build_dir(rel_path) -> Column:
    """True when a file lies below a directory named .git or target (F1)."""
    segs = F.split(_c(rel_path), "/")
    dirs = F.slice(segs, 1, F.size(segs) - 1)
    return F.arrays_overlap(dirs, F.array(*[F.lit(d) for d in PRUNED_DIRS]))


def flat_name(rel_path, max_bytes: int = FLAT_NAME_MAX_BYTES) -> Column:
    """Flat item name.

    Path components are joined by ``__``; while the result is longer than
    ``max_bytes`` UTF-8 bytes the leading directory is dropped.  The basename
    is never cut, so a long basename alone may still exceed the bound.

    Three native paths, cheapest first:
    * the whole name fits: one ``replace``;
    * ASCII path (bytes = characters): mark every ``/`` as two NUL characters
      (NUL cannot occur in a file name, and the mark is as long as ``__``);
      the earliest mark followed by at most ``max_bytes`` characters up to
      the end starts the longest suffix that fits;
    * otherwise one linear pass over the directory byte lengths (a lambda,
      interpreted, but only for long non-ASCII paths).
    """
    path = _c(rel_path)
    base = F.substring_index(path, "/", -1)
    full = F.replace(path, F.lit("/"), F.lit(FLAT_SEPARATOR))
    fits = F.octet_length(full) <= max_bytes
    mark = "\u0000\u0000"
    # ASCII and free of NUL (a table input could hold one; a file system cannot).
    ascii_only = (F.octet_length(path) == F.length(path)) & ~F.contains(path, F.lit("\u0000"))
    marked = F.replace(path, F.lit("/"), F.lit(mark))
    # A mark followed by at most max_bytes characters lies inside the last
    # max_bytes + 2 characters; the first such mark starts the answer.
    window = F.right(marked, F.lit(max_bytes + len(mark)))
    at = F.instr(window, mark)
    tail = F.substr(window, at + len(mark))
    ascii_cut = F.when(at > 0, F.replace(tail, F.lit(mark), F.lit(FLAT_SEPARATOR))).otherwise(base)
    return (
        F.when(fits, full)
        .when(ascii_only, ascii_cut)
        .otherwise(_flat_name_bytes(F.split(path, "/"), base, max_bytes))
    )


def _flat_name_bytes(segs: Column, base: Column, max_bytes: int) -> Column:
    n_dirs = F.size(segs) - 1
    dirs = F.slice(segs, 1, n_dirs)
    sep = len(FLAT_SEPARATOR)
    full_len = F.aggregate(
        dirs, F.octet_length(base).cast("long"), lambda acc, d: acc + F.octet_length(d) + sep
    )
    # state: (bytes of the candidate name, directories dropped so far)
    start = F.struct(full_len.alias("len"), F.lit(0).alias("drop"))
    state = F.aggregate(
        dirs,
        start,
        lambda acc, d: F.when(
            acc["len"] > max_bytes,
            F.struct(
                (acc["len"] - F.octet_length(d) - sep).alias("len"),
                (acc["drop"] + 1).alias("drop"),
            ),
        ).otherwise(acc),
    )
    drop = state["drop"]
    kept = F.slice(dirs, drop + 1, n_dirs - drop)
    return F.when(drop < n_dirs, F.concat(F.array_join(kept, FLAT_SEPARATOR), F.lit(FLAT_SEPARATOR), base)).otherwise(base)


def page_hierarchy(ancestors, title) -> Column:
    """Ancestor titles in order, those without a title skipped, then the own title."""
    anc_titles = F.transform(F.coalesce(_c(ancestors), F.array()), lambda a: a["title"])
    kept = F.filter(anc_titles, lambda t: t.isNotNull())
    return F.concat(kept, F.array(F.coalesce(_c(title), F.lit(UNTITLED))))


def page_stem(parts) -> Column:
    """File-system safe stem of a page.

    In each part the unsafe characters become ``_`` and then one pass turns
    ``__`` into ``_``; parts are joined by ``__`` and ``_``/``.`` are
    stripped from both ends of the whole name.  The result may be empty.
    """
    cleaned = F.transform(
        _c(parts),
        lambda p: F.replace(F.translate(p, PAGE_UNSAFE, "_" * len(PAGE_UNSAFE)), F.lit("__"), F.lit("_")),
    )
    return F.btrim(F.array_join(cleaned, FLAT_SEPARATOR), F.lit(PAGE_STEM_STRIP))
