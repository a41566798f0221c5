"""Readers of landed sources, by the type that the catalogue names.

A reader turns the folders of its type into ``files`` rows; another kind of
source is plugged in with :func:`register_reader`, as another processor is
with ``process.register_processor``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.operators import wiki
from quire.sources import landed, treescan


@dataclass
class ReadOptions:
    """Where things have landed; a reader takes what concerns it."""

    tree_root: str | None = None
    wiki_responses: str | None = None
    page_limit: int | None = None
    extra: dict | None = None


@dataclass
class Read:
    """``files`` (schemas.FILES, maybe with ``modified``), ``rejects``, and the folders nothing has landed for."""

    files: DataFrame | None
    absent: list[str]
    rejects: DataFrame | None = None


Reader = Callable[[SparkSession, list[str], ReadOptions], Read]


def read_repositories(spark: SparkSession, folders: list[str], options: ReadOptions) -> Read:
    """Repository snapshots ``tree_root/<source_dir>/...``."""
    root = options.tree_root
    present = [d for d in folders if root is not None and treescan.has_folder(root, d)]
    files = treescan.read_tree(spark, root, sources=present) if present else None
    return Read(files, [d for d in folders if d not in set(present)])


def read_spaces(spark: SparkSession, folders: list[str], options: ReadOptions) -> Read:
    """Wiki spaces from landed responses, through stop, cap, names and last write wins."""
    if options.wiki_responses is None:
        return Read(None, folders)
    responses = landed.read_responses(spark, options.wiki_responses)
    spaces = landed.space_documents(responses)
    landed.check_spaces(spaces)
    files, rejects = wiki.wiki_files(landed.content_batches(responses), spaces, page_limit=options.page_limit)
    there = {r["source_dir"] for r in responses.select("source_dir").distinct().collect()}
    return Read(files, [d for d in folders if d not in there], rejects)


READERS: dict[str, Reader] = {"git": read_repositories, "confluence": read_spaces}


def register_reader(type_: str, reader: Reader) -> None:
    """Read sources of this type with ``reader(spark, folders, options)``."""
    READERS[type_] = reader


def read_sources(spark: SparkSession, manifest: DataFrame, options: ReadOptions) -> tuple[DataFrame, DataFrame, list[str]]:
    """Files of every source of the manifest, rejects, and the folders nothing has landed for."""
    files, rejects, absent = spark.createDataFrame([], schemas.FILES), spark.createDataFrame([], schemas.REJECTS), []
    types = {r["type"]: r["dirs"] for r in manifest.groupBy("type").agg(F.collect_set("source_dir").alias("dirs")).collect()}
    for type_, dirs in sorted(types.items()):  # configuration-sized
        got = READERS[type_](spark, sorted(dirs), options)
        absent += got.absent
        if got.files is not None:
            files = files.unionByName(got.files, allowMissingColumns=True)
        if got.rejects is not None:
            rejects = rejects.unionByName(got.rejects, allowMissingColumns=True)
    return files, rejects, absent
