import uuid

import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.operators import bucket, report
from quire.operators.store import DedupStore, TableStore
from quire.plans import sync
from tests.test_process import files_df, manifest_df


@pytest.fixture()
def tables(spark, tmp_path):
    tag = uuid.uuid4().hex[:8]
    store = TableStore(spark, f"bs_{tag}", f"bi_{tag}")
    store.ensure(str(tmp_path))
    yield store.sources_table, store.items_table
    for t in (store.sources_table, store.items_table, store.commits_table):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def seed(spark, tables, bucket_id, *sources):
    """Put sources (id, name) without items into a bucket."""
    rows = [(bucket_id, i, n, 0, None, n) for i, n in sources]
    df = spark.createDataFrame(rows, schemas.BUCKET_SOURCES + ", source_dir string")
    TableStore(spark, *tables).replace(bucket_id, df, spark.createDataFrame([], schemas.STORED_ITEMS), (max(i for i, _ in sources), 0))


def run(spark, tree, dirs, tables, bucket_id=7, **kw):
    s, i = tables
    return sync.synchronise(spark, files_df(spark, tree), manifest_df(spark, dirs), bucket_id,
                            sources_table=s, items_table=i, **kw)


def test_report_two_items_one_source(spark, tables):
    res = run(spark, {"s": {"main.rs": b"fn main(){}", "lib.rs": b"pub fn f(){}"}}, ["s"], tables)
    rows = res.report.collect()
    assert len(rows) == 1
    items = rows[0]["items"]
    assert [x["item_name"] for x in items] == ["lib.rs", "main.rs"]
    assert all(x["item_id"] > 0 for x in items) and rows[0]["source_id"] > 0


def test_two_sources_two_report_rows_and_empty_source(spark, tables):
    res = run(spark, {"g": {"lib.rs": b"x"}, "w": {"main.md": b"y"}}, ["g", "w", "empty"], tables)
    rows = {r["source_name"]: r["items"] for r in res.report.collect()}
    assert {k: [x["item_name"] for x in v] for k, v in rows.items()} == {
        "name-g": ["lib.rs"], "name-w": ["main.md"], "name-empty": []}


def test_refresh_replaces_old_sources_only_in_its_bucket(spark, tables):
    s, i = tables
    seed(spark, tables, 7, (9001, "old"))
    seed(spark, tables, 8, (42, "other"))
    run(spark, {"s": {"a.txt": b"a"}}, ["s"], tables)
    ids = {(r["bucket_id"], r["external_source_id"]) for r in spark.table(s).collect()}
    assert (7, 9001) not in ids and (8, 42) in ids
    assert any(b == 7 and sid > 9001 for b, sid in ids)


def test_zero_sources_empties_exactly_one_bucket(spark, tables):
    s, i = tables
    run(spark, {"s": {"a.txt": b"a"}}, ["s"], tables, bucket_id=7)
    run(spark, {"s": {"b.txt": b"b"}}, ["s"], tables, bucket_id=8)
    empty_man = spark.createDataFrame([], schemas.MANIFEST)
    empty_files = spark.createDataFrame([], schemas.FILES)
    res = sync.synchronise(spark, empty_files, empty_man, 7, sources_table=s, items_table=i)
    assert res.report.count() == 0
    assert {r["bucket_id"] for r in spark.table(s).collect()} == {8}
    assert {r["bucket_id"] for r in spark.table(i).collect()} == {8}


def test_failing_gate_leaves_old_content(spark, tables):
    s, i = tables
    run(spark, {"s": {"a.txt": b"a"}}, ["s"], tables)
    before = sorted(map(tuple, spark.table(i).select("external_item_id", "url").collect()))
    with pytest.raises(bucket.GateError, match="b.txt"):
        run(spark, {"s": {"b.txt": b"b"}}, ["s"], tables,
            backend_state=F.when(F.col("url") == "b.txt", F.lit("Failed")))
    after = sorted(map(tuple, spark.table(i).select("external_item_id", "url").collect()))
    assert before == after


def test_strict_readme_failure(spark, tables):
    with pytest.raises(RuntimeError, match="no_readme"):
        run(spark, {"s": {"a.txt": b"a"}}, ["s"], tables, kind="readme2pdf")


def test_bad_bucket_id(spark, tables):
    with pytest.raises(ValueError):
        run(spark, {"s": {"a.txt": b"a"}}, ["s"], tables, bucket_id=2**31)


def test_lossy_item_content_and_hash(spark):
    files = files_df(spark, {"s": {"a": b"\x01\x02\x03\x04", "b": b"\xc3\x28"}})
    man = manifest_df(spark, ["s"])
    from quire.operators import process

    items, _ = process.flatten_files(files, man)
    src = bucket.load_sources(man, 7)
    loaded = {r["url"]: r for r in bucket.load_items(items, src).collect()}
    assert loaded["a"]["content"] == "\x01\x02\x03\x04"
    assert loaded["b"]["content"] == "�("
    import hashlib

    assert loaded["b"]["content_hash"] == hashlib.sha256("�(".encode()).hexdigest()
    assert {r["processing_state"] for r in loaded.values()} == {"Submitted"}


def test_delete_and_lookup(spark):
    srcs = spark.createDataFrame([(7, 101, "a", 0, None), (7, 102, "b", 0, None), (8, 5, "c", 0, None)], schemas.BUCKET_SOURCES)
    items = spark.createDataFrame(
        [(7, 101, 1, "x", "", "", "Submitted", "Active", None), (7, 102, 2, "y", "", "", "Submitted", "Active", None)],
        schemas.BUCKET_ITEMS)
    assert sorted(r["external_source_id"] for r in bucket.list_sources(srcs, 7).collect()) == [101, 102]
    assert bucket.get_source(srcs, 5).collect()[0]["external_source_name"] == "c"
    ks, ki = bucket.delete_sources(srcs, items, spark.createDataFrame([(101,)], "external_source_id int"))
    assert sorted(r["external_source_id"] for r in ks.collect()) == [5, 102]
    assert [r["external_item_id"] for r in ki.collect()] == [2]
    kept = bucket.delete_items(items, spark.createDataFrame([(102, 2)], "external_source_id long, external_item_id long"))
    assert [r["external_item_id"] for r in kept.collect()] == [1]
    counts = {r["source_id"]: r["n_items"] for r in report.items_per_source(ks, ki).collect()}
    assert counts == {5: 0, 102: 1}


def test_report_parts_are_bounded(spark):
    srcs = spark.createDataFrame([(7, 1, "a", 0, None)], schemas.BUCKET_SOURCES)
    items = spark.range(1, 26).select(
        F.lit(7).cast("long").alias("bucket_id"), F.lit(1).cast("long").alias("external_source_id"),
        F.col("id").alias("external_item_id"), F.concat(F.lit("f"), F.col("id").cast("string")).alias("url"),
        F.lit("").alias("content"), F.lit("").alias("content_hash"), F.lit("Submitted").alias("processing_state"),
        F.lit("Active").alias("state"), F.lit(None).cast("string").alias("updated_datetime"))
    rows = report.sync_report(srcs, items, part_items=10).orderBy("part").collect()
    assert [len(r["items"]) for r in rows] == [10, 10, 5]
    assert [x["item_id"] for r in rows for x in r["items"]] == list(range(1, 26))


def test_repeated_paths_keep_every_item(spark):
    from quire.operators import process

    rows = [("s", "d/f", 1, bytearray(b"b")), ("s", "d/f", 1, bytearray(b"a")), ("s", "e", 1, bytearray(b"c"))]
    files = spark.createDataFrame(rows, schemas.FILES)
    man = manifest_df(spark, ["s"])
    items, _ = process.flatten_files(files, man)
    loaded = bucket.load_items(items, bucket.load_sources(man, 7))
    got = sorted((r["external_item_id"], r["url"], r["content"]) for r in loaded.collect())
    import hashlib

    first, second = sorted(["a", "b"], key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert got == [(1, "d__f", first), (2, "d__f", second), (3, "e", "c")]


def test_refresh_with_no_sources_deletes_existing(spark, tables):
    s, i = tables
    seed(spark, tables, 7, (101, "a"), (102, "b"))
    empty_man = spark.createDataFrame([], schemas.MANIFEST)
    res = sync.synchronise(spark, spark.createDataFrame([], schemas.FILES), empty_man, 7, sources_table=s, items_table=i)
    spark.catalog.refreshTable(s)
    assert spark.table(s).count() == 0 and res.report.count() == 0


def test_a_crash_anywhere_leaves_the_bucket_whole(spark, tables, monkeypatch):
    """Between any two writes of a refresh: readers see the old rows, the next refresh works and cleans up."""
    store = TableStore(spark, *tables)
    look = lambda: sorted((r["external_item_id"], r["url"]) for r in store.items(7).collect())
    run(spark, {"s": {"a.txt": b"a"}, "t": {"t.txt": b"t"}}, ["s", "t"], tables)
    for stop in range(3):
        before = look(), sorted(map(tuple, store.sources(7).collect()))
        with monkeypatch.context() as m:
            done = []

            def stops(self, table, df, real=TableStore._write, stop=stop, done=done):
                if len(done) == stop:
                    raise RuntimeError("lost driver")
                done.append(table)
                real(self, table, df)

            m.setattr(TableStore, "_write", stops)
            with pytest.raises(RuntimeError, match="lost driver"):
                run(spark, {"s": {"b.txt": b"b"}}, ["s"], tables)
        assert (look(), sorted(map(tuple, store.sources(7).collect()))) == before
    res = run(spark, {"s": {"b.txt": b"b"}}, ["s"], tables)
    assert [u for _, u in look()] == ["b.txt"] and res.n_items == 1
    spark.catalog.refreshTable(tables[1])
    assert spark.table(tables[1]).count() == 1  # nothing else is left


def test_reads_prune_partitions(spark, tables):
    run(spark, {"s": {"a.txt": b"a"}}, ["s"], tables)
    plan = TableStore(spark, *tables).items(7)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "bucket_id" in filters and "generation" in filters and "DataFilters: []" in plan
    one = TableStore(spark, *tables).stored_items(7, [3])._jdf.queryExecution().executedPlan().toString()
    assert "slot" in one.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_unchanged_items_keep_their_ids(spark):
    man = manifest_df(spark, ["s"])
    src = bucket.load_sources(man, 7)
    from quire.operators import process

    def load(rows, base, previous=None):
        files = spark.createDataFrame([("s", p, 1, bytearray(c)) for p, c in rows], schemas.FILES)
        loaded = bucket.load_items(process.flatten_files(files, man)[0], src, id_base=base, previous=previous, keep=("source_dir", "rel_path"))
        return loaded, sorted((r["rel_path"], r["content"], r["external_item_id"]) for r in loaded.collect())

    old, rows = load([("a", b"1"), ("b", b"2"), ("c", b"3"), ("c", b"3")], 0)
    assert rows == [("a", "1", 1), ("b", "2", 2), ("c", "3", 3), ("c", "3", 4)]
    _, rows = load([("b", b"2"), ("a", b"9"), ("0", b"0"), ("c", b"3"), ("c", b"3"), ("c", b"3")], 4, old)
    assert rows == [("0", "0", 5), ("a", "9", 6), ("b", "2", 2), ("c", "3", 3), ("c", "3", 4), ("c", "3", 7)]


def test_contents_are_read_once(spark, tables):
    """A load reads each content once, from its source; numbering moves keys alone."""
    man = manifest_df(spark, ["s"])
    src = bucket.load_sources(man, 7)
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            reads.add(len(pdf))
            yield pdf

    files = files_df(spark, {"s": {f"f{i}": b"x" for i in range(50)}}).mapInPandas(count, schemas.FILES)
    from quire.operators import process

    loaded = bucket.load_items(process.flatten_files(files, man)[0], src)
    assert bucket.check_gate(loaded) == 50 and loaded.count() == 50 and reads.value == 50


def test_report_parts_of_a_hot_source(spark):
    """A source with a third of the items: its parts are in order and no list is longer than a part."""
    sid = F.when(F.col("id") < 400, F.lit(1)).otherwise(F.col("id") % 40 + 2).cast("long")
    items = spark.range(1200).select(sid.alias("external_source_id"), F.row_number().over(__import__("pyspark").sql.Window.orderBy(sid, "id")).cast("long").alias("external_item_id"), F.col("id").cast("string").alias("url"))
    sources = spark.range(1, 43).select(F.col("id").alias("external_source_id"), F.col("id").cast("string").alias("external_source_name"))
    rows = report.sync_report(sources, items, part_items=64).orderBy("source_id", "part").collect()
    assert max(len(r["items"]) for r in rows) == 64
    hot = [r for r in rows if r["source_id"] == 1]
    assert [r["part"] for r in hot] == list(range(7)) and [x["item_id"] for r in hot for x in r["items"]] == list(range(1, 401))
    assert [r["items"] for r in rows if r["source_id"] == 42] == [[]]


def test_contents_are_stored_once(spark, tmp_path):
    """The same items as without, a row for each distinct content; a refresh of a folder adds only what is new."""
    tree = {"s": {"a": b"1", "b": b"2", "c": b"1"}, "t": {"d": b"1", "e": b""}}
    man, tag = manifest_df(spark, ["s", "t"]), uuid.uuid4().hex[:8]
    got = {}
    for kind in (TableStore, DedupStore):
        store = kind(spark, f"ds_{tag}_{kind.__name__}", f"di_{tag}_{kind.__name__}")
        store.ensure(str(tmp_path / kind.__name__))
        res = sync.synchronise(spark, files_df(spark, tree), man, 7, store=store)
        got[kind] = sorted(map(tuple, store.items(7).collect())), res.n_items, sorted(map(str, res.report.collect()))
    assert got[TableStore] == got[DedupStore]
    texts = lambda: sorted(r["content"] for r in store.contents(7).collect())
    assert texts() == ["", "1", "2"]
    from quire.streaming import incremental

    incremental.refresh_sources(spark, files_df(spark, {"t": {"d": b"2", "f": b"new"}}), man, 7, "", "", store=store)
    assert texts() == ["", "1", "2", "new"]
    assert sorted((r["url"], r["content"]) for r in store.items(7).collect()) == [("a", "1"), ("b", "2"), ("c", "1"), ("d", "2"), ("f", "new")]
    sync.synchronise(spark, files_df(spark, {"s": {"a": b"1"}}), manifest_df(spark, ["s"]), 7, store=store)
    assert texts() == ["1"] and spark.table(store.contents_table).count() == 1
