"""Uploading a load's items to a store of any kind, as a Spark data source.

A store takes items in tasks and says what became of each; the load counts
only when Spark commits the write:

* :meth:`ItemStore.put` runs in tasks.  It keeps the items of one task under
  the load's name and yields a state for each.
* :meth:`ItemStore.publish` runs once on the driver, after every task, if all
  items were ``Submitted`` (F7); the load appears by it alone.
* :meth:`ItemStore.discard` runs instead where a task failed for good or the
  gate closed.  What the bucket held before is untouched.

``register(spark, "name", store)`` makes ``df.write.format("name")`` such a
write.  A task that ran twice has put its items twice: only parts named by
Spark's commit messages belong to the load.
"""

from __future__ import annotations

import json
import uuid
from abc import ABC, abstractmethod
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from quire import schemas
from quire.operators.bucket import SUBMITTED, GateError
from quire.session import ship


@dataclass
class Part(WriterCommitMessage):
    """What one task put: where, how many items by state, and one that was not ``Submitted``."""

    name: str
    states: Counter = field(default_factory=Counter)
    refused: tuple[str, str | None] | None = None


class ItemStore(ABC):
    @abstractmethod
    def put(self, load: str, part: str, batches: Iterator[pa.RecordBatch]) -> Iterator[list[str | None]]:
        """Keep the batches as a part of the load; yields the states of each batch's items."""

    @abstractmethod
    def publish(self, load: str, parts: list[str], options: dict[str, str]) -> None:
        """Make the load what the store holds."""

    @abstractmethod
    def discard(self, load: str, parts: list[str]) -> None:
        """Remove a load that was not published."""


class _Writer(DataSourceArrowWriter):
    def __init__(self, store: ItemStore, options: dict[str, str]):
        self.store, self.options = store, options
        self.load = options.get("load") or uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        part = Part(uuid.uuid4().hex)
        waiting: list[pa.RecordBatch] = []

        def seen() -> Iterator[pa.RecordBatch]:
            for batch in iterator:
                waiting.append(batch.select(["url"]))
                yield batch

        for states in self.store.put(self.load, part.name, seen()):
            urls = waiting.pop(0).column("url")
            part.states.update(states)
            if part.refused is None:
                part.refused = next(((urls[i].as_py(), s) for i, s in enumerate(states) if s != SUBMITTED), None)
        return part

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        parts = [m for m in messages if m is not None]
        refused = sorted((p.refused for p in parts if p.refused), key=str)
        if refused:  # Spark aborts the write
            url, state = refused[0]
            raise GateError(f"item processing_state was not '{SUBMITTED}': file={url} state={state!r}")
        self.store.publish(self.load, [p.name for p in parts if p.states], self.options)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.store.discard(self.load, [m.name for m in messages if m is not None])


def register(spark: SparkSession, name: str, store: ItemStore) -> None:
    """Let ``df.write.format(name)`` upload to ``store``, which must pickle."""
    ship(spark)

    class Upload(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite) -> _Writer:
            return _Writer(store, dict(self.options))

    spark.dataSource.register(Upload)


class FolderStore(ItemStore):
    """Items as parquet parts in a folder of any ``pyarrow.fs`` file system; ``current-<bucket>.json`` names a bucket's parts."""

    def __init__(self, root: str | pafs.FileSystem):
        if isinstance(root, pafs.FileSystem):
            self.fs, self.base = root, ""
        elif "://" in root or root.startswith("file:"):
            self.fs, self.base = pafs.FileSystem.from_uri(root if "://" in root else root.replace("file:", "file://", 1))
        else:
            self.fs, self.base = pafs.LocalFileSystem(), root

    def path(self, *names: str) -> str:
        return "/".join([*([self.base.rstrip("/")] if self.base else []), *names])

    def put(self, load: str, part: str, batches: Iterator[pa.RecordBatch]) -> Iterator[list[str | None]]:
        sink = None
        for batch in batches:
            if sink is None:
                self.fs.create_dir(self.path(load), recursive=True)
                sink = pq.ParquetWriter(self.path(load, f"{part}.parquet"), batch.schema, filesystem=self.fs)
            sink.write_batch(batch)
            yield batch.column("processing_state").to_pylist()
        if sink is not None:
            sink.close()

    def publish(self, load: str, parts: list[str], options: dict[str, str]) -> None:
        bucket_id = int(options["bucket_id"])
        files = [self.path(load, f"{p}.parquet") for p in sorted(parts)]
        body = json.dumps({"files": files, "more": json.loads(options.get("more", "{}"))})
        draft = self.path(f"draft-{load}.json")
        with self.fs.open_output_stream(draft) as out:
            out.write(body.encode())
        before = self.current(bucket_id)
        self.fs.move(draft, self.path(f"current-{bucket_id}.json"))
        for old in {f.rpartition("/")[0] for f in before.get("files", [])} - {self.path(load)}:
            self.fs.delete_dir(old)

    def discard(self, load: str, parts: list[str]) -> None:
        if self.fs.get_file_info(self.path(load)).type == pafs.FileType.Directory:
            self.fs.delete_dir(self.path(load))

    def current(self, bucket_id: int) -> dict:
        """The published load of a bucket: its files and what the caller kept beside them."""
        path = self.path(f"current-{int(bucket_id)}.json")
        if self.fs.get_file_info(path).type != pafs.FileType.File:
            return {}
        with self.fs.open_input_stream(path) as src:
            return json.loads(src.read())

    def buckets(self) -> list[int]:
        found = self.fs.get_file_info(pafs.FileSelector(self.base or "/", allow_not_found=True))
        names = [i.base_name for i in found if i.base_name.startswith("current-")]
        return sorted(int(n.removeprefix("current-").removesuffix(".json")) for n in names)


class FolderBucket:
    """A bucket kept in a :class:`FolderStore`, for :func:`quire.plans.sync.synchronise` in place of the tables.

    Sources are few and lie beside the list of parts, so sources and items
    change by one move.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.store, self.format = spark, FolderStore(root), f"folder_{uuid.uuid4().hex}"

    def ensure(self) -> None:
        register(self.spark, self.format, self.store)

    def last_ids(self) -> tuple[int, int]:
        last = [self.store.current(b)["more"]["last_ids"] for b in self.store.buckets()]
        return (max((x[0] for x in last), default=0), max((x[1] for x in last), default=0))

    def replace(self, bucket_id: int, sources: DataFrame, items: DataFrame, last_ids: tuple[int, int]) -> None:
        rows = [r.asDict() for r in sources.collect()]  # configuration-sized
        more = json.dumps({"sources": rows, "last_ids": list(last_ids)})
        items.write.format(self.format).option("bucket_id", str(bucket_id)).option("more", more).mode("append").save()

    def sources(self, bucket_id: int) -> DataFrame:
        rows = self.store.current(bucket_id).get("more", {}).get("sources", [])
        names = [c.split()[0] for c in schemas.BUCKET_SOURCES.split(", ")]
        return self.spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schemas.BUCKET_SOURCES)

    def items(self, bucket_id: int) -> DataFrame:
        files = self.store.current(bucket_id).get("files", [])
        if not files:
            return self.spark.createDataFrame([], schemas.BUCKET_ITEMS)
        return self.spark.read.schema(schemas.BUCKET_ITEMS).parquet(*files)
