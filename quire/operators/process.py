"""Processors: snapshot files of each manifest source -> items.

``files``    (source_dir, rel_path, length, content)
``manifest`` (pos, logical_name, source_dir, ...)
``items``    (pos, source_name, source_dir, rel_path, filename, content)

The manifest is one row per configured source; it is joined to the files
of its folder (J1).  The same source configured twice yields its items
twice, as in the reference.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.naming import FLATTEN_KINDS, READMETOPDF_KINDS, flat_name, in_build_dir
from quire.functions.pdf import README_PDF_NAME, README_SOURCE_NAME, readme_pdf_stub
from quire.functions.text import lossy_utf8
from quire.operators.sizing import bounded_broadcast


def _sources(manifest: DataFrame) -> DataFrame:
    return manifest.select("pos", F.col("logical_name").alias("source_name"), "source_dir")


def flatten_files(
    files: DataFrame, manifest: DataFrame, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """FlattenFiles: every file not below .git/target becomes an item named by P7.

    ``keep`` names extra file columns carried onto the items.
    """
    kept = files.where(~in_build_dir("rel_path"))
    items = kept.join(bounded_broadcast(_sources(manifest)), "source_dir").select(
        "pos",
        "source_name",
        "source_dir",
        "rel_path",
        flat_name("rel_path").alias("filename"),
        "content",
        *keep,
    )
    return items, _no_rejects(files)


def readme_files(files: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ReadmeToPDF: one ``README.pdf`` item per source with a root ``README.md``.

    The payload is the fixed placeholder document; the README text travels
    in ``source_text``.  A source without one is a ``no_readme`` reject (F4).
    """
    readmes = files.where(F.col("rel_path") == README_SOURCE_NAME).select(
        "source_dir", lossy_utf8("content").alias("source_text")
    )
    sources = bounded_broadcast(_sources(manifest))
    items = readmes.join(sources, "source_dir").select(
        "pos",
        "source_name",
        "source_dir",
        F.lit(README_SOURCE_NAME).alias("rel_path"),
        F.lit(README_PDF_NAME).alias("filename"),
        readme_pdf_stub().alias("content"),
        "source_text",
    )
    return items, missing_readme(files, manifest)


def missing_readme(files: DataFrame, manifest: DataFrame) -> DataFrame:
    present = files.where(F.col("rel_path") == README_SOURCE_NAME).select("source_dir")
    return (
        _sources(manifest)
        .join(present, "source_dir", "left_anti")
        .select(
            "source_dir",
            F.lit(README_SOURCE_NAME).alias("rel_path"),
            F.lit("no_readme").alias("reason"),
            "source_name",
        )
        .withColumnRenamed("source_name", "detail")
    )


def _no_rejects(like: DataFrame) -> DataFrame:
    spark = like.sparkSession
    from quire.schemas import REJECTS

    return spark.createDataFrame([], REJECTS)


Processor = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]

PROCESSORS: dict[str, Processor] = {
    "FlattenFiles": flatten_files,
    "ReadmeToPDF": readme_files,
}


def register_processor(name: str, fn: Processor) -> None:
    """Plug in a processor: ``fn(files, manifest) -> (items, rejects)``, selected by ``name``.

    Items must have the columns of :func:`flatten_files`' output.
    """
    PROCESSORS[name] = fn


def canonical_kind(kind: str | None) -> tuple[str, bool]:
    """(canonical processor name, whether the spelling was known) — P16 on the driver."""
    if kind in READMETOPDF_KINDS:
        return "ReadmeToPDF", True
    if kind in FLATTEN_KINDS:
        return "FlattenFiles", True
    if kind in PROCESSORS:
        return kind, True
    return "FlattenFiles", False


def process(files: DataFrame, manifest: DataFrame, kind: str | None = "FlattenFiles"):
    name, known = canonical_kind(kind)
    if not known:
        import logging

        logging.getLogger("quire").warning("unknown processor kind %r, using FlattenFiles", kind)
    return PROCESSORS[name](files, manifest)
