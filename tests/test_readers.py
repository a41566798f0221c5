"""A reader of one's own; the paging stop over a stream."""

import itertools
import uuid

import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.operators import wiki
from quire.operators.store import TableStore
from quire.plans import sync
from quire.sources import catalogue, readers
from quire.streaming import paging


def test_a_reader_of_ones_own(spark, tmp_path):
    def read_notes(spark, folders, options):
        rows = [(d, "note.txt", 1, bytearray(options.extra["notes"][d].encode())) for d in folders if d in options.extra["notes"]]
        return readers.Read(spark.createDataFrame(rows, schemas.FILES), [d for d in folders if d not in options.extra["notes"]])

    records = [{"type": "notes", "repo_url": "a/b"}, {"type": "notes", "repo_url": "c", "reference": "v1"}]
    with pytest.raises(ValueError, match="unknown_type"):
        sync.sync_landed(spark, catalogue.sources_frame(spark, records), 7)
    readers.register_reader("notes", read_notes)
    try:
        tag = uuid.uuid4().hex[:8]
        store = TableStore(spark, f"rs_{tag}", f"ri_{tag}")
        store.ensure(str(tmp_path))
        run = lambda notes: sync.sync_landed(spark, catalogue.sources_frame(spark, records), 7, store=store, reader_options={"notes": notes}, strict=len(notes) == 2)
        res = run({"notes_a_b_main": "x", "notes_c_v1": "y"})
        assert {r["source_name"]: [i["item_name"] for i in r["items"]] for r in res.report.collect()} == {"a/b": ["note.txt"], "c": ["note.txt"]}
        res = run({"notes_c_v1": "y"})
        assert [(r["source_dir"], r["reason"]) for r in res.rejects.collect()] == [("notes_a_b_main", "snapshot_missing")]
    finally:
        del readers.READERS["notes"]


PAGE = "struct<title:string, body:struct<storage:struct<value:string>>, ancestors:array<struct<title:string>>>"


def responses(spark, rows):
    """(source, start, status, parsed, number of results)"""
    page = ("t", None, None)
    return spark.createDataFrame([(s, a, st, p, [page] * n) for s, a, st, p, n in rows], f"source_dir string, start int, status int, parsed boolean, results array<{PAGE}>")


def test_paging_over_a_stream_equals_the_batch(spark, tmp_path):
    rows = [
        ("a", 0, 200, True, 2), ("a", 2, 503, True, 0), ("a", 4, 200, True, 1), ("a", 2, 200, True, 2), ("a", 2, 200, True, 1), ("a", 6, 200, True, 2),
        ("b", 2, 200, True, 2), ("b", 0, 200, False, 2), ("b", 0, 200, True, 2), ("b", 3, 200, True, 2), ("b", 4, 200, True, 2),
        ("c", 0, 200, True, 0), ("c", 2, 200, True, 2),
        ("d", 2, 200, True, 2),
        ("e", 0, 500, True, 2), ("e", 2, 200, True, 1),
    ]
    landing = str(tmp_path / "landing")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        schema = schemas.CONTENT_BATCHES
        for part in itertools.batched(rows, 5):  # late and repeated responses come in later micro-batches
            responses(spark, part).coalesce(1).write.mode("append").parquet(landing)
            stream = spark.readStream.schema(schema).parquet(landing).withColumn("copy", F.lit("x"))
            q = paging.kept_responses(stream, 2).writeStream.format("parquet").option("path", str(tmp_path / "kept")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
            q.awaitTermination(180)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = sorted((r["source_dir"], r["start"], r["n"]) for r in spark.read.parquet(str(tmp_path / "kept")).collect())
    batch = wiki.kept_batches(responses(spark, rows).coalesce(1), 2)
    assert got == sorted((r["source_dir"], r["start"], r["n"]) for r in batch.collect())
    assert got == [("a", 0, 2), ("a", 2, 2), ("a", 4, 1), ("b", 0, 2), ("b", 2, 2), ("b", 4, 2), ("c", 0, 0)]
