"""A refresh never loses data without an error: broken catalogues, absent snapshots, odd folder names, foreign folders."""

import pytest

from quire.operators import report
from quire.plans.sync import sync_landed
from quire.sources import catalogue, snapshot, treescan


@pytest.mark.parametrize("content", ["[{", '{"type": "git"}x', '"text"', ""])
def test_broken_catalogue_fails(spark, tmp_path, content):
    (tmp_path / "sources.json").write_text(content)
    with pytest.raises(Exception, match="malformed source catalogue"):
        catalogue.read_sources(spark, str(tmp_path / "sources.json")).collect()


def test_empty_catalogue_is_no_error(spark, tmp_path):
    (tmp_path / "sources.json").write_text("[]")
    assert catalogue.read_sources(spark, str(tmp_path / "sources.json")).count() == 0


@pytest.mark.parametrize("tree", [True, False])
def test_absent_snapshot_fails_before_writing(spark, tmp_path, tree):
    sources = catalogue.sources_frame(spark, [{"type": "git", "repo_url": "https://host/a/b.git", "reference": "main"}])
    with pytest.raises(RuntimeError, match="snapshot_missing"):
        sync_landed(spark, sources, 5, str(tmp_path) if tree else None, sources_table="loss_s", items_table="loss_i")
    assert not spark.catalog.tableExists("loss_s")


def test_folder_name_with_comma(spark, tmp_path):
    for d in ("git_a,b_main", "git_c_main"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "x.txt").write_text(d)
    got = treescan.read_tree(spark, str(tmp_path), sources=["git_a,b_main", "git_c_main"]).collect()
    assert sorted(r.source_dir for r in got) == ["git_a,b_main", "git_c_main"]


def test_snapshot_leaves_other_folders(spark, tmp_path):
    schema = "source_dir string, rel_path string, length long, content binary"
    row = lambda d, c: (d, "f.txt", 1, bytearray(c))
    dirs = lambda *d: spark.createDataFrame([(x,) for x in d], "source_dir string")
    snapshot.ensure_snapshot_table(spark, "loss_snap", str(tmp_path))
    snapshot.replace_snapshots(spark, "loss_snap", spark.createDataFrame([row("a", b"1"), row("b", b"1")], schema), dirs("a", "b"))
    snapshot.replace_snapshots(spark, "loss_snap", spark.createDataFrame([row("a", b"2"), row("b", b"2")], schema), dirs("a"))
    got = {r.source_dir: bytes(r.content) for r in snapshot.read_snapshots(spark, "loss_snap").collect()}
    spark.sql("DROP TABLE loss_snap")
    spark.sql("DROP TABLE loss_snap_folders")
    assert got == {"a": b"2", "b": b"1"}


def test_one_report_row_a_source(spark):
    sources = spark.createDataFrame([(1, "s"), (2, "none")], "external_source_id long, external_source_name string")
    items = spark.createDataFrame([(1, 10_000, "x"), (1, 10_001, "y"), (1, 10_002, "z")], "external_source_id long, external_item_id long, url string")
    whole = {r.source_id: r for r in report.sync_report(sources, items).collect()}
    assert [i.item_id for i in whole[1]["items"]] == [10_000, 10_001, 10_002] and whole[2]["items"] == []
    cut = report.sync_report(sources, items, part_items=2).where("source_id = 1").orderBy("part").collect()
    assert [(r.part, len(r["items"])) for r in cut] == [(0, 2), (1, 1)]
