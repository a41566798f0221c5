import json
import uuid

from pyspark.sql import functions as F

from quire import schemas
from quire.operators import audit
from quire.operators.store import SLOTS, TableStore
from quire.sources import catalogue, snapshot
from quire.streaming import incremental
from tests.test_process import files_df


def test_catalogue_and_manifest(spark, tmp_path):
    records = [
        {"type": "git", "repo_url": "https://github.com/o/r", "reference": None},
        {"type": "confluence", "base_url": "https://dummy.atlassian.net/wiki//", "space_key": "DUMMY"},
        {"type": "git", "repo_url": "https://github.com/o/r"},
        {"type": "svn", "repo_url": "x"},
        {"type": "confluence", "base_url": "https://w"},
    ]
    p = tmp_path / "sources.json"
    p.write_text(json.dumps(records))
    from_file = catalogue.read_sources(spark, str(p))
    from_list = catalogue.sources_frame(spark, records)
    assert sorted(map(tuple, from_file.collect())) == sorted(map(tuple, from_list.collect()))
    bad = {r["pos"]: r["reason"] for r in catalogue.invalid_sources(from_list).collect()}
    assert bad == {3: "unknown_type", 4: "missing_space"}
    m = catalogue.manifest(from_list).where("pos < 3").orderBy("pos").collect()
    assert [r["source_dir"] for r in m] == [
        "git_https___github.com_o_r_main",
        "confluence_https___dummy.atlassian.net_wiki_DUMMY",
        "git_https___github.com_o_r_main",
    ]
    assert m[1]["logical_name"] == "https://dummy.atlassian.net/wiki//:DUMMY"
    assert m[0]["original_source"]["repo_url"] == "https://github.com/o/r"
    lp = catalogue.manifest(from_list, root="/land/").where("pos = 0").first()["local_path"]
    assert lp == "/land/git_https___github.com_o_r_main"


def test_empty_catalogue(spark):
    assert catalogue.manifest(catalogue.sources_frame(spark, [])).count() == 0


def test_snapshot_replace(spark, tmp_path):
    t = f"snap_{uuid.uuid4().hex[:8]}"
    snapshot.ensure_snapshot_table(spark, t, str(tmp_path))
    snapshot.replace_snapshots(spark, t, files_df(spark, {"a": {"x": b"1", "old": b"2"}, "b": {"y": b"3"}}),
                               spark.createDataFrame([("a",), ("b",)], "source_dir string"))
    # re-snapshot a (one file gone) and c (new); b becomes empty; nothing else changes
    snapshot.replace_snapshots(spark, t, files_df(spark, {"a": {"x": b"9"}, "c": {"z": b"4"}}),
                               spark.createDataFrame([("a",), ("b",), ("c",)], "source_dir string"))
    got = sorted((r["source_dir"], r["rel_path"], bytes(r["content"])) for r in snapshot.read_snapshots(spark, t).collect())
    assert got == [("a", "x", b"9"), ("c", "z", b"4")]
    spark.sql(f"DROP TABLE {t}")


def test_recent_files_prune_folders(spark, tmp_path):
    t = f"snap_{uuid.uuid4().hex[:8]}"
    snapshot.ensure_snapshot_table(spark, t, str(tmp_path))
    rows = [(f"d'{k}\\é", f"f{i}", 1, bytearray(b"x"), 100 * k + i) for k in range(6) for i in range(5)]
    files = spark.createDataFrame(rows, "source_dir string, rel_path string, length long, content binary, s long").withColumn("modified", F.timestamp_seconds("s")).drop("s")
    dirs = files.select("source_dir").distinct()
    snapshot.replace_snapshots(spark, t, files, dirs)
    recent = snapshot.recent_files(spark, t, "1970-01-01 00:06:43")  # second 403
    assert sorted((r["source_dir"], r["rel_path"]) for r in recent.collect()) == sorted((d, p) for d, p, _, _, s in rows if s >= 403)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "source_dir" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = {r["f"] for r in recent.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    assert len({f.rpartition("/")[0] for f in read}) == 2  # of six folders
    # A folder without its row (a refresh that stopped) is read in any case; a time that isn't known counts as old.
    spark.createDataFrame([], schemas.SNAPSHOT_FOLDERS).write.insertInto(snapshot.folders_table(t), overwrite=True)
    spark.catalog.refreshTable(snapshot.folders_table(t))
    assert snapshot.recent_files(spark, t, "1970-01-01 00:06:43").count() == 7
    snapshot.replace_snapshots(spark, t, files.drop("modified").where("source_dir like 'd_5%'"), dirs.where("source_dir like 'd_5%' or source_dir like 'd_4%'"))
    assert snapshot.recent_files(spark, t, "1970-01-01 00:06:43").count() == 0
    assert snapshot.read_snapshots(spark, t).count() == 25  # five folders left, one of them emptied
    for name in (t, snapshot.folders_table(t)):
        spark.sql(f"DROP TABLE {name}")


def test_snapshot_contents_are_read_once(spark, tmp_path):
    t = f"snap_{uuid.uuid4().hex[:8]}"
    snapshot.ensure_snapshot_table(spark, t, str(tmp_path))
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            reads.add(len(pdf))
            yield pdf

    files = files_df(spark, {"a": {f"f{i}": b"x" for i in range(40)}, "b": {"y": b"z"}}).mapInPandas(count, schemas.FILES)
    snapshot.replace_snapshots(spark, t, files, spark.createDataFrame([("a",), ("b",), ("c",)], "source_dir string"))
    assert snapshot.read_snapshots(spark, t).count() == 41 and reads.value == 41
    for name in (t, snapshot.folders_table(t)):
        spark.sql(f"DROP TABLE {name}")


def test_recently_modified(spark):
    df = spark.createDataFrame([("a", "2026-01-01 00:00:00"), ("b", "2026-06-01 00:00:00")], "p string, modified string")
    df = df.withColumn("modified", F.to_timestamp("modified"))
    assert [r["p"] for r in audit.recently_modified(df, "2026-03-01").collect()] == ["b"]


def test_incremental_stream(spark, tmp_path):
    tag = uuid.uuid4().hex[:8]
    s, i = f"ss_{tag}", f"si_{tag}"
    TableStore(spark, s, i).ensure(str(tmp_path))
    landing = tmp_path / "landing"
    man = spark.createDataFrame([(1, "repo-a", "a", "git"), (2, "repo-b", "b", "git")], schemas.MANIFEST)
    files_df(spark, {"a": {"x.txt": b"1", "d/y.txt": b"2"}, "b": {"z.txt": b"3"}}).write.parquet(str(landing / "1"))

    def run():
        q = incremental.start(spark, str(landing) + "/*", man, 7, str(tmp_path / "ck"), s, i, available_now=True)
        q.awaitTermination(120)
        spark.catalog.refreshTable(s)
        spark.catalog.refreshTable(i)

    run()
    names = sorted(r["url"] for r in spark.table(i).collect())
    assert names == ["d__y.txt", "x.txt", "z.txt"]
    files_df(spark, {"a": {"x.txt": b"new"}}).write.parquet(str(landing / "2"))
    run()
    rows = sorted((r["url"], r["content"]) for r in spark.table(i).collect())
    assert rows == [("x.txt", "new"), ("z.txt", "3")]
    assert sorted(r["external_source_name"] for r in spark.table(s).collect()) == ["repo-a", "repo-b"]
    spark.sql(f"DROP TABLE {s}")
    spark.sql(f"DROP TABLE {i}")


def _tables(spark, tmp_path):
    tag = uuid.uuid4().hex[:8]
    return f"ss_{tag}", f"si_{tag}"


def test_refresh_keeps_the_other_reference(spark, tmp_path):
    s, i = _tables(spark, tmp_path)
    # One repository at two references: one display name, two folders.
    man = spark.createDataFrame([(1, "repo", "r_main", "git"), (2, "repo", "r_v1", "git")], schemas.MANIFEST)
    incremental.refresh_sources(spark, files_df(spark, {"r_main": {"m.txt": b"1"}, "r_v1": {"v.txt": b"1"}}), man, 7, s, i)
    incremental.refresh_sources(spark, files_df(spark, {"r_main": {"m.txt": b"2"}}), man, 7, s, i)
    assert sorted((r["url"], r["content"]) for r in spark.table(i).collect()) == [("m.txt", "2"), ("v.txt", "1")]
    assert spark.table(s).count() == 2


def test_replay_after_a_crash_between_the_writes(spark, tmp_path, monkeypatch):
    s, i = _tables(spark, tmp_path)
    man = spark.createDataFrame([(1, "repo", "r", "git"), (2, "other", "o", "git")], schemas.MANIFEST)
    incremental.refresh_sources(spark, files_df(spark, {"r": {"old.txt": b"1"}, "o": {"o.txt": b"1"}}), man, 7, s, i)
    new = files_df(spark, {"r": {"new.txt": b"2"}})
    store = TableStore(spark, s, i)
    for crash_after in (0, 1, 2):
        done = []

        def stops(self, table, df, real=TableStore._write, done=done, crash_after=crash_after):
            if len(done) == crash_after:
                raise RuntimeError("lost driver")
            done.append(table)
            real(self, table, df)

        with monkeypatch.context() as m:
            m.setattr(TableStore, "_write", stops)
            try:
                incremental.refresh_sources(spark, new, man, 7, s, i)
            except RuntimeError as e:
                assert "lost driver" in str(e)
        if crash_after == 0:
            assert sorted(r["url"] for r in store.items(7).collect()) == ["o.txt", "old.txt"]
        incremental.refresh_sources(spark, new, man, 7, s, i)
        ids = {r["external_source_id"] for r in spark.table(s).collect()}
        items = spark.table(i).collect()
        assert sorted(r["url"] for r in items) == ["new.txt", "o.txt"]
        assert {r["external_source_id"] for r in items} == ids and len(ids) == 2


def test_a_micro_batch_writes_its_slots_only(spark, tmp_path):
    s, i = _tables(spark, tmp_path)
    store = TableStore(spark, s, i)
    store.ensure(str(tmp_path / "store"))
    dirs = [f"d{k}" for k in range(40)]
    man = spark.createDataFrame([(k, f"repo-{d}", d, "git") for k, d in enumerate(dirs)], schemas.MANIFEST)
    incremental.refresh_sources(spark, files_df(spark, {d: {"x.txt": b"1", "y.txt": b"2"} for d in dirs}), man, 7, s, i)
    files = lambda: {r["f"]: r["slot"] for r in store.stored_items(7).select("slot", F.col("_metadata.file_path").alias("f")).distinct().collect()}
    before, ids = files(), {(r["source_dir"], r["rel_path"]): r["external_item_id"] for r in store.stored_items(7).collect()}
    assert len(set(before.values())) > SLOTS // 2
    rejects = incremental.refresh_sources(spark, files_df(spark, {"d3": {"x.txt": b"1", "y.txt": b"new"}, "nobody": {"z": b"3"}}), man, 7, s, i)
    assert [(r["source_dir"], r["reason"]) for r in rejects.collect()] == [("nobody", "unknown_source")]
    after, now = files(), {(r["source_dir"], r["rel_path"]): r["external_item_id"] for r in store.stored_items(7).collect()}
    touched = {v for f, v in after.items() if f not in before}
    assert len(touched) == 1 and {f for f, v in before.items() if v not in touched} <= set(after)
    assert {k for k in ids if now[k] != ids[k]} == {("d3", "y.txt")} and now[("d3", "y.txt")] == 81


def test_rejects_of_a_stream_are_kept(spark, tmp_path):
    s, i = _tables(spark, tmp_path)
    man = spark.createDataFrame([(1, "repo", "r", "git"), (2, "other", "o", "git")], schemas.MANIFEST)
    landing, kept = tmp_path / "landing", f"rej_{s}"
    files_df(spark, {"r": {"README.md": b"1"}, "o": {"x": b"2"}}).write.parquet(str(landing / "1"))
    start = lambda: incremental.start(spark, f"{landing}/*", man, 7, str(tmp_path / "ck"), s, i, kind="ReadmeToPDF", available_now=True, rejects_table=kept)
    start().awaitTermination(120)
    assert [r["url"] for r in TableStore(spark, s, i).items(7).collect()] == ["README.pdf"]
    assert [(r["source_dir"], r["reason"], r["batch_id"]) for r in spark.table(kept).collect()] == [("o", "no_readme", 0)]
    spark.sql(f"DROP TABLE {kept}")


def test_commit_seen_in_two_micro_batches(spark, tmp_path):
    s, i = _tables(spark, tmp_path)
    man = spark.createDataFrame([(1, "repo", "r", "git")], schemas.MANIFEST)
    landing = tmp_path / "landing"
    run = lambda: incremental.start(spark, f"{landing}/*", man, 7, str(tmp_path / "ck"), s, i, available_now=True).awaitTermination(120)
    files_df(spark, {"r": {"a.txt": b"1"}}).coalesce(1).write.parquet(str(landing / "0001"))
    run()
    files_df(spark, {"r": {"b.txt": b"2"}}).coalesce(1).write.mode("append").parquet(str(landing / "0001"))
    run()
    spark.catalog.refreshTable(i)
    assert sorted(r["url"] for r in spark.table(i).collect()) == ["a.txt", "b.txt"]


def test_sync_landed_end_to_end(spark, tmp_path):
    import os

    from quire.plans import sync

    git_dir = "git_https___example.com_o_r_main"
    wiki_dir = "confluence_https___w.example.com_wiki_K"
    for rel, data in {"README.md": b"# r\n", "src/lib.rs": b"fn f(){}", ".git/HEAD": b"ref", "target/x.o": b"\x00"}.items():
        p = tmp_path / "trees" / git_dir / rel
        os.makedirs(p.parent, exist_ok=True)
        p.write_bytes(data)
    responses = [
        {"source_dir": wiki_dir, "status": 200, "body": json.dumps({"key": "K"})},
        {"source_dir": wiki_dir, "start": 0, "status": 200, "body": json.dumps({"results": [
            {"title": "main", "body": {"storage": {"value": "<h1>Main</h1>"}}, "ancestors": []}]})},
    ]
    (tmp_path / "wiki.jsonl").write_text("\n".join(json.dumps(r) for r in responses))
    sources = catalogue.sources_frame(spark, [
        {"type": "git", "repo_url": "https://example.com/o/r"},
        {"type": "confluence", "base_url": "https://w.example.com/wiki/", "space_key": "K"},
    ])
    tag = uuid.uuid4().hex[:8]
    s, i = f"es_{tag}", f"ei_{tag}"
    TableStore(spark, s, i).ensure(str(tmp_path))
    snap = f"sn_{tag}"
    snapshot.ensure_snapshot_table(spark, snap, str(tmp_path / "snap"))
    res = sync.sync_landed(spark, sources, 7, str(tmp_path / "trees"), str(tmp_path / "wiki.jsonl"),
                           sources_table=s, items_table=i, snapshot_table=snap)
    rep = {r["source_name"]: sorted(x["item_name"] for x in r["items"]) for r in res.report.collect()}
    assert rep == {
        "https://example.com/o/r": ["README.md", "src__lib.rs"],
        "https://w.example.com/wiki/:K": ["main.md", "space.json"],
    }
    assert res.n_sources == 2 and res.n_items == 4
    landed_paths = sorted((r["source_dir"], r["rel_path"]) for r in spark.table(snap).collect())
    assert (git_dir, "src/lib.rs") in landed_paths and (wiki_dir, "space.json") in landed_paths


def test_sync_landed_rejects_invalid_catalogue(spark):
    import pytest

    from quire.plans import sync

    sources = catalogue.sources_frame(spark, [{"type": "svn", "repo_url": "x"}])
    with pytest.raises(ValueError, match="unknown_type"):
        sync.sync_landed(spark, sources, 7, sources_table="never_created_s", items_table="never_created_i")
    assert not spark.catalog.tableExists("never_created_s")
