"""Scan landed repository snapshots ``<root>/<source_dir>/...`` into ``files`` rows.

Spark's ``binaryFile`` source drops every name starting with ``.`` or ``_``
(``.gitignore``, ``__init__.py``), so folders are listed here, by rounds over
a *frontier* table of folders.  Each round is a Spark job: a task lists the
folders it is dealt and those below them until it has seen ``budget`` names,
and gives back names and the folders it did not come to, which are the next
round's frontier.  The driver lists the root only.  Names come first; sizes
and times are read afterwards in evenly dealt tasks, contents after that, so
neither one flat folder nor one long chain is one task's work.

Folders named ``.git`` or ``target`` are not entered (F1); only regular files
are taken, links are followed, broken links skipped (F2); a folder that stands
on its own path (a link back) is not entered again.

Snapshots may lie in any store that :mod:`pyarrow.fs` opens: ``root`` is a
path, a URI or a ``pyarrow.fs.FileSystem``.  Paths and ``file:`` URIs go
through ``os``, which also takes names that aren't UTF-8 and knows links.
"""

from __future__ import annotations

import os
import stat
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.naming import PRUNED_DIRS
from quire.operators.stage import land
from quire.schemas import REJECTS
from quire.session import ship, staging_path

LISTING_SCHEMA = "source_dir string, rel_path string, length bigint, modified timestamp, path binary"
#: Names a listing task sees for one folder of the frontier before it hands the rest back.
BUDGET = 4096
_FOUND = "kind string, source_dir string, rel_path string, path binary, above array<string>"
_FOLDER, _FILE, _UNKNOWN = "d", "f", "?"


def _lossy(name: str) -> str:
    """A path component as text; undecodable bytes become U+FFFD."""
    return os.fsencode(name).decode("utf-8", "replace")


class PosixTree:
    """A mounted folder."""

    def __init__(self, root: str):
        self.root = root

    def join(self, folder: str, name: str) -> str:
        return os.path.join(folder, name)

    def names(self, folder: str) -> list[tuple[str, str]]:
        """(name, kind) of a folder's entries, without a stat: a link's kind is unknown."""
        with os.scandir(folder) as entries:
            kinds = [(e.name, _UNKNOWN if e.is_symlink() else _FOLDER if e.is_dir(follow_symlinks=False) else _FILE if e.is_file(follow_symlinks=False) else _UNKNOWN) for e in entries]
        return sorted(kinds)

    def identity(self, folder: str) -> str | None:
        st = os.stat(folder)
        return f"{st.st_dev}:{st.st_ino}"

    def info(self, path: str) -> tuple[str, int, int]:
        """(kind, bytes, modified in microseconds), links followed; the kind is empty for anything else or gone."""
        try:
            st = os.stat(path)
        except OSError:
            return "", 0, 0
        kind = _FILE if stat.S_ISREG(st.st_mode) else _FOLDER if stat.S_ISDIR(st.st_mode) else ""
        return kind, st.st_size, st.st_mtime_ns // 1000

    def read(self, path: str) -> bytes:
        with open(path, "rb") as fh:
            return fh.read()


class ArrowTree:
    """A folder of a ``pyarrow.fs`` file system, an object store for one (which has no links)."""

    def __init__(self, fs: pafs.FileSystem, root: str = ""):
        self.fs, self.root = fs, root.rstrip("/")

    def join(self, folder: str, name: str) -> str:
        return f"{folder}/{name}" if folder else name

    def names(self, folder: str) -> list[tuple[str, str]]:
        kinds = {pafs.FileType.Directory: _FOLDER, pafs.FileType.File: _FILE}
        return sorted((i.base_name, kinds[i.type]) for i in self.fs.get_file_info(pafs.FileSelector(folder)) if i.type in kinds)

    def identity(self, folder: str) -> str | None:
        return None

    def info(self, path: str) -> tuple[str, int, int]:
        i = self.fs.get_file_info(path)
        if i.type == pafs.FileType.File:
            return _FILE, i.size, (i.mtime_ns or 0) // 1000
        return (_FOLDER if i.type == pafs.FileType.Directory else ""), 0, 0

    def read(self, path: str) -> bytes:
        with self.fs.open_input_stream(path) as fh:
            return fh.read()


def tree_of(root: str | pafs.FileSystem) -> PosixTree | ArrowTree:
    if isinstance(root, pafs.FileSystem):
        return ArrowTree(root)
    if "://" in root and not root.startswith("file:"):
        return ArrowTree(*pafs.FileSystem.from_uri(root))
    return PosixTree(_posix_root(root))


def has_folder(root: str | pafs.FileSystem, source_dir: str) -> bool:
    """Whether a snapshot of this source is there."""
    tree = tree_of(root)
    return tree.info(tree.join(tree.root, source_dir))[0] == _FOLDER


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.list_(pa.string())]
    cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(cols, ["kind", "source_dir", "rel_path", "path", "above"])


def _walker(tree: PosixTree | ArrowTree, budget: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Frontier folders -> names below them, and the folders left for the next round."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for source, rel, path, above in zip(*(batch.column(c).to_pylist() for c in ("source_dir", "rel_path", "path", "above")), strict=True):
                seen, todo = 0, deque([(rel, os.fsdecode(path), above)])
                while todo:
                    rel, folder, above = todo.popleft()
                    if seen >= budget:
                        out.append((_FOLDER, source, rel, os.fsencode(folder), above))
                        continue
                    own = tree.identity(folder)
                    if own in above:  # a link back to a folder above
                        continue
                    below = above if own is None else [*above, own]
                    for name, kind in tree.names(folder):
                        seen += 1
                        at, full = f"{rel}/{_lossy(name)}" if rel else _lossy(name), tree.join(folder, name)
                        if kind == _FOLDER:
                            if name not in PRUNED_DIRS:
                                todo.append((at, full, below))
                        else:
                            out.append((kind, source, at, os.fsencode(full), below if kind == _UNKNOWN else None))
                        if len(out) >= 4096:
                            yield _batch(out)
                            out = []
        if out:
            yield _batch(out)

    return walk


def _resolver(tree: PosixTree | ArrowTree) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Entries of unknown kind -> what they lead to."""

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                kind = tree.info(os.fsdecode(row[3]))[0]
                if kind == _FILE or (kind == _FOLDER and row[2].rpartition("/")[2] not in PRUNED_DIRS):
                    rows.append((kind, *row[1:]))
            if rows:
                yield _batch(rows)

    return resolve


def _statter(tree: PosixTree | ArrowTree) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Names of files -> listing rows; what is no regular file (any more) is left out."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            infos = [tree.info(os.fsdecode(p)) for p in batch.column("path").to_pylist()]
            keep = [i for i, x in enumerate(infos) if x[0] == _FILE]
            source, rel, path = (batch.column(c).take(pa.array(keep, pa.int64())) for c in ("source_dir", "rel_path", "path"))
            cols = [source, rel, pa.array([infos[i][1] for i in keep], pa.int64()), pa.array([infos[i][2] for i in keep], pa.timestamp("us", "UTC")), path]
            yield pa.RecordBatch.from_arrays(cols, ["source_dir", "rel_path", "length", "modified", "path"])

    return look


def _tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def list_tree(spark: SparkSession, root: str | pafs.FileSystem, sources: list[str] | None = None, budget: int = BUDGET) -> DataFrame:
    """Landed listing (:data:`LISTING_SCHEMA`) of the files below ``root``, of the given source folders or of all."""
    ship(spark)
    tree, n = tree_of(root), _tasks(spark)
    if sources is None:
        sources = [name for name, kind in tree.names(tree.root) if kind != _FILE]
    tops = [(s, tree.join(tree.root, s)) for s in sources]
    tops = [("", s, "", bytearray(os.fsencode(p)), []) for s, p in tops if tree.info(p)[0] == _FOLDER]
    frontier = spark.createDataFrame(tops, _FOUND)
    written: list[str] = []

    def step(rows: DataFrame, work: Callable) -> dict[str, int]:
        """One job over evenly dealt rows; counts of what it found."""
        path = staging_path(spark, "tree-round")
        rows.repartition(n, F.xxhash64("path")).mapInArrow(work, _FOUND).write.parquet(path)
        written.append(path)
        done = spark.read.schema(_FOUND).parquet(path)
        return {r["kind"]: r["n"] for r in done.groupBy("kind").agg(F.count("*").alias("n")).collect()}

    left = len(tops)
    while left:
        found = step(frontier, _walker(tree, budget))
        latest, left = written[-1:], found.get(_FOLDER, 0)
        if found.get(_UNKNOWN):
            entries = spark.read.schema(_FOUND).parquet(*latest).where(F.col("kind") == _UNKNOWN)
            left += step(entries, _resolver(tree)).get(_FOLDER, 0)
            latest = written[-2:]
        frontier = spark.read.schema(_FOUND).parquet(*latest).where(F.col("kind") == _FOLDER)
    if not written:
        return spark.createDataFrame([], LISTING_SCHEMA)
    files = spark.read.schema(_FOUND).parquet(*written).where(F.col("kind") == _FILE).select("source_dir", "rel_path", "path")
    return land(files.repartition(n, F.xxhash64("path")).mapInArrow(_statter(tree), LISTING_SCHEMA), "tree-listing")


def _content_reader(tree: PosixTree | ArrowTree, budget: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads each listed file whole, yielding batches of at most ``budget`` bytes (one file at least)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = batch.select(["source_dir", "rel_path", "length", "modified"])
            start, size, data = 0, 0, []
            for i, path in enumerate(batch.column("path").to_pylist()):
                data.append(tree.read(os.fsdecode(path)))  # an unreadable file fails the job, as in the reference
                size += len(data[-1])
                if size >= budget or i + 1 == batch.num_rows:
                    part = keep.slice(start, len(data))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], [*part.schema.names, "content"])
                    start, size, data = i + 1, 0, []

    return read


def tree_files(
    spark: SparkSession,
    root: str | pafs.FileSystem,
    sources: list[str] | None = None,
    max_file_bytes: int | None = None,
    budget: int = BUDGET,
) -> tuple[DataFrame, DataFrame]:
    """``files`` rows (+ ``modified``) of every snapshot under ``root``, and rejects.

    One file is one row; files larger than ``max_file_bytes`` aren't read but
    come as ``file_too_large`` rejects.
    """
    listing = list_tree(spark, root, sources, budget)
    rejects = spark.createDataFrame([], REJECTS)
    if max_file_bytes is not None:
        large = F.col("length") > max_file_bytes
        detail = F.concat(F.lit("bytes="), F.col("length").cast("string"))
        rejects = listing.where(large).select("source_dir", "rel_path", F.lit("file_too_large").alias("reason"), detail.alias("detail"))
        listing = listing.where(~large)
    limit = _bytes(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "64m"))
    schema = "source_dir string, rel_path string, length bigint, modified timestamp, content binary"
    dealt = listing.repartition(_tasks(spark), "source_dir", "rel_path")
    return dealt.mapInArrow(_content_reader(tree_of(root), limit), schema), rejects


def read_tree(
    spark: SparkSession,
    root: str | pafs.FileSystem,
    sources: list[str] | None = None,
    with_content: bool = True,
    budget: int = BUDGET,
) -> DataFrame:
    """``files`` rows (+ ``modified``) of every snapshot under ``root``, of any size."""
    if not with_content:
        return list_tree(spark, root, sources, budget).drop("path")
    return tree_files(spark, root, sources, budget=budget)[0]


def _bytes(text: str) -> int:
    text = text.strip().lower().rstrip("b")
    mult = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)
    return int(text[:-1] if text[-1:] in ("k", "m", "g") else text) * mult


def _posix_root(uri: str) -> str:
    if uri.startswith("file:"):
        uri = uri[len("file:"):]
        while uri.startswith("//"):
            uri = uri[1:]
        return uri
    if "://" in uri:
        raise ValueError(f"tree landing needs a shared POSIX folder, got {uri}")
    return uri


def land_tree(files: DataFrame, order: str = "doc_id") -> str:
    """Write ``files`` rows as a folder tree under the checkpoint folder; returns its root.

    Equal paths keep the row with the largest ``order`` value (last write wins).
    """
    spark = files.sparkSession
    ship(spark)
    root = _posix_root(staging_path(spark, "tree"))
    rows = files.groupBy("source_dir", "rel_path").agg(
        F.max_by(F.col("content"), F.col(order)).alias("content")
    )

    def write(batches):
        n = 0
        for pdf in batches:
            for sd, rp, content in zip(pdf["source_dir"], pdf["rel_path"], pdf["content"]):
                full = os.path.join(root, sd, rp)
                os.makedirs(os.path.dirname(full), exist_ok=True)
                with open(full, "wb") as fh:
                    fh.write(content)
                n += 1
        yield pd.DataFrame({"n": [n]})

    os.makedirs(root, exist_ok=True)
    rows.mapInPandas(write, "n long").agg(F.sum("n")).collect()
    return root


def land_links(root: str, links: DataFrame) -> None:
    """Add symbolic links (source_dir, rel_path, to) to a landed tree; ``to`` is taken as it is."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = 0
        for pdf in batches:
            for folder, rel, to in zip(pdf["source_dir"], pdf["rel_path"], pdf["to"], strict=True):
                full = os.path.join(root, folder, rel)
                os.makedirs(os.path.dirname(full), exist_ok=True)
                if not os.path.islink(full):  # a task may run twice
                    os.symlink(to, full)
                n += 1
        yield pd.DataFrame({"n": [n]})

    links.select("source_dir", "rel_path", "to").mapInPandas(write, "n long").agg(F.sum("n")).collect()
