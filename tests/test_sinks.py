"""Uploading items to a store of any kind through Spark's writer: commit, abort, gate, a store of one's own."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.operators import bucket
from quire.plans import sync
from quire.sinks import upload
from tests.test_process import files_df, manifest_df


class LineStore(upload.ItemStore):
    """A toy: names as JSON lines; refuses items whose name holds ``refuse``."""

    def __init__(self, root):
        self.root = root

    def put(self, load, part, batches):
        with open(os.path.join(self.root, f"{load}-{part}"), "w") as out:
            for batch in batches:
                urls = batch.column("url").to_pylist()
                if any("crash" in u for u in urls):
                    raise RuntimeError("lost task")
                out.writelines(json.dumps(u) + "\n" for u in urls)
                yield ["Failed" if "refuse" in u else "Submitted" for u in urls]

    def publish(self, load, parts, options):
        with open(os.path.join(self.root, f"current-{options['bucket_id']}"), "w") as out:
            json.dump([f"{load}-{p}" for p in parts], out)

    def discard(self, load, parts):
        for name in os.listdir(self.root):
            if name.startswith(load):
                os.remove(os.path.join(self.root, name))

    def held(self, bucket_id):
        with open(os.path.join(self.root, f"current-{bucket_id}")) as src:
            return sorted(json.loads(line) for name in json.load(src) for line in open(os.path.join(self.root, name)))


def items(spark, *urls):
    return spark.createDataFrame([(u,) for u in urls], "url string").repartition(3, "url")


def test_a_store_of_ones_own(spark, tmp_path):
    store = LineStore(str(tmp_path))
    upload.register(spark, "lines", store)
    write = lambda *urls: items(spark, *urls).write.format("lines").option("bucket_id", "7").mode("append").save()
    write("a", "b", "c", "d")
    assert store.held(7) == ["a", "b", "c", "d"]
    files = sorted(os.listdir(tmp_path))
    with pytest.raises(Exception, match="file=refuse-me state='Failed'"):
        write("x", "refuse-me", "y")
    with pytest.raises(Exception, match="lost task"):
        write("x", "crash", "y")
    assert store.held(7) == ["a", "b", "c", "d"] and sorted(os.listdir(tmp_path)) == files
    write()
    assert store.held(7) == []


def test_refresh_into_a_folder(spark, tmp_path):
    """The full refresh with a folder in place of the tables: same report, gate and ids."""
    store = upload.FolderBucket(spark, str(tmp_path / "store"))
    run = lambda tree, dirs, bucket_id=7, **kw: sync.synchronise(spark, files_df(spark, tree), manifest_df(spark, dirs), bucket_id, store=store, **kw)
    res = run({"g": {"lib.rs": b"x", "a/b.txt": b"y"}, "w": {"main.md": b"z"}}, ["g", "w", "empty"])
    report = {r["source_name"]: [x["item_name"] for x in r["items"]] for r in res.report.collect()}
    assert report == {"name-g": ["a__b.txt", "lib.rs"], "name-w": ["main.md"], "name-empty": []}
    run({"o": {"o.txt": b"o"}}, ["o"], bucket_id=8)
    before = sorted(map(tuple, store.items(7).collect()))
    with pytest.raises(bucket.GateError):
        run({"g": {"new": b"n"}}, ["g"], backend_state=F.lit("Failed"))
    assert sorted(map(tuple, store.items(7).collect())) == before
    res = run({"g": {"new": b"n"}}, ["g"])
    assert [(r["external_item_id"], r["url"], r["content"]) for r in store.items(7).collect()] == [(5, "new", "n")]
    assert [r["external_source_id"] for r in store.sources(7).collect()] == [5]
    assert [r["url"] for r in store.items(8).collect()] == ["o.txt"] and store.items(9).count() == 0
    assert store.items(7).schema.fieldNames() == spark.createDataFrame([], schemas.BUCKET_ITEMS).schema.fieldNames()
