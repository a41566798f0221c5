import os

import pyarrow.fs as pafs
from pyspark.sql import functions as F

from quire.operators import process
from quire.sources import treescan
from tests.test_process import manifest_df


def build(root):
    def put(rel, data=b"x"):
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(data)

    s = "repo"
    for rel in ["root.txt", "src/module/nested.md", ".gitignore", ".github/ci.yml", "pkg/__init__.py", "_p/q",
                "bin/target", "targets/x", ".git/config", "sub/target/y", "sub/.git/z", "target/deep/temp.obj"]:
        put(f"{s}/{rel}", rel.encode())
    put(f"{s}/empty.txt", b"")
    os.symlink(os.path.join(root, s, "root.txt"), os.path.join(root, s, "link.txt"))
    os.symlink(os.path.join(root, s, "missing"), os.path.join(root, s, "broken.txt"))
    os.symlink(os.path.join(root, s, "src"), os.path.join(root, s, "src", "module", "loop"))
    raw = os.path.join(os.fsencode(root), b"repo", b"bad\xffname.txt")
    with open(raw, "wb") as fh:
        fh.write(b"\xff")
    os.makedirs(os.path.join(root, "emptyrepo"))


def test_tree_scan(spark, tmp_path):
    root = str(tmp_path)
    build(root)
    files = treescan.read_tree(spark, root)
    got = {(r["source_dir"], r["rel_path"]): bytes(r["content"]) for r in files.collect()}
    rels = sorted(p for _, p in got)
    assert rels == sorted([
        ".gitignore", ".github/ci.yml", "_p/q", "bad�name.txt", "bin/target", "empty.txt", "link.txt",
        "pkg/__init__.py", "root.txt", "src/module/nested.md", "targets/x",
    ])
    assert got[("repo", "link.txt")] == b"root.txt"
    assert got[("repo", "empty.txt")] == b""
    items, _ = process.flatten_files(files, manifest_df(spark, ["repo", "emptyrepo"]))
    names = sorted(r["filename"] for r in items.collect())
    assert "src__module__nested.md" in names and ".gitignore" in names and "pkg____init__.py" in names


def test_listing_only(spark, tmp_path):
    build(str(tmp_path))
    listing = treescan.read_tree(spark, str(tmp_path), sources=["repo"], with_content=False)
    lengths = {r["rel_path"]: r["length"] for r in listing.collect()}
    assert lengths["root.txt"] == len(b"root.txt") and lengths["empty.txt"] == 0


def test_budget_does_not_change_result(spark, tmp_path):
    root = str(tmp_path)
    build(root)
    # a link to a sibling folder is walked (no cycle), like any folder
    os.symlink(os.path.join(root, "repo", "pkg"), os.path.join(root, "repo", "src", "pkglink"))
    os.symlink(os.path.join(root, "repo", "pkg"), os.path.join(root, "repo", "src", "target"))  # pruned by name
    results = []
    for budget in (1, 3, 4096):
        listing = treescan.read_tree(spark, root, with_content=False, budget=budget)
        results.append(sorted((r["source_dir"], r["rel_path"]) for r in listing.collect()))
    assert results[0] == results[1] == results[2]
    rels = [p for _, p in results[0]]
    assert "src/pkglink/__init__.py" in rels and "pkg/__init__.py" in rels
    assert not any("loop" in p or "src/target" in p for p in rels)


def test_large_files_chunked_and_size_bound(spark, tmp_path):
    root = tmp_path
    for i in range(6):
        p = root / "big" / f"f{i}.bin"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(bytes([i]) * (300_000 + i))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "512k")
    try:
        files = treescan.read_tree(spark, str(root))
        got = {r["rel_path"]: bytes(r["content"]) for r in files.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert got == {f"f{i}.bin": bytes([i]) * (300_000 + i) for i in range(6)}
    small, rejects = treescan.tree_files(spark, str(root), max_file_bytes=300_002)
    assert sorted(r["rel_path"] for r in small.collect()) == ["f0.bin", "f1.bin", "f2.bin"]
    assert sorted((r["rel_path"], r["reason"]) for r in rejects.collect()) == [(f"f{i}.bin", "file_too_large") for i in (3, 4, 5)]
    assert treescan._bytes("64m") == 64 << 20 and treescan._bytes("67108864b") == 67108864


def shares(df):
    """Rows of each task, as shares of all."""
    counts = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    return [c / sum(counts) for c in counts]


def test_flat_folder_and_long_chain_are_many_tasks_work(spark, tmp_path, monkeypatch):
    flat, chain = tmp_path / "flat" / "repo" / "all", tmp_path / "chain"
    flat.mkdir(parents=True)
    for i in range(20_000):
        (flat / f"f{i}").touch()
    folder = chain / "repo"
    for level in range(200):
        folder = folder / "d"
        folder.mkdir(parents=True)
        for i in range(10):
            (folder / f"f{i}").write_bytes(b"%d" % level)
    files = treescan.read_tree(spark, str(tmp_path / "flat"))
    assert files.count() == 20_000 and max(shares(files)) <= 0.25
    rounds = []
    monkeypatch.setattr(treescan, "staging_path", lambda s, label, real=treescan.staging_path: rounds.append(real(s, label)) or rounds[-1])
    files = treescan.read_tree(spark, str(chain), budget=400)
    rows = files.collect()
    assert len(rows) == 2000 and max(shares(files)) <= 0.25
    assert max(len(r["rel_path"]) for r in rows) == len("/".join(["d"] * 200) + "/f0")
    names = [spark.read.parquet(r).where("kind = 'f'").count() for r in rounds]  # one task each, as it is a chain
    assert sum(names) == 2000 and max(names) <= 500


def test_other_file_systems(spark, tmp_path):
    """By path, by file URI and through a file system object: hidden names are kept everywhere."""
    for rel in ("repo/.gitignore", "repo/_a/__init__.py", "repo/.git/config", "repo/b/target/x", "repo/b/target2", "other/x"):
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(rel.encode())
    want = [("other", "x"), ("repo", ".gitignore"), ("repo", "_a/__init__.py"), ("repo", "b/target2")]
    sub = pafs.SubTreeFileSystem(str(tmp_path), pafs.LocalFileSystem())
    for root in (str(tmp_path), f"file://{tmp_path}", sub):
        got = sorted((r["source_dir"], r["rel_path"], bytes(r["content"]), r["length"], r["modified"] is not None) for r in treescan.read_tree(spark, root, budget=1).collect())
        assert got == [(s, p, f"{s}/{p}".encode(), len(s) + 1 + len(p), True) for s, p in want]
        assert [r["rel_path"] for r in treescan.read_tree(spark, root, sources=["other", "absent"], with_content=False).collect()] == ["x"]
        assert treescan.has_folder(root, "repo") and not treescan.has_folder(root, "absent")
    assert isinstance(treescan.tree_of(sub), treescan.ArrowTree)
    assert treescan.read_tree(spark, str(tmp_path), sources=[]).count() == 0
