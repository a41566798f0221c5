
from quire import schemas
from quire.functions.pdf import PDF_STUB
from quire.operators import process


def files_df(spark, tree: dict[str, dict[str, bytes]]):
    rows = [(sd, rp, len(c), bytearray(c)) for sd, t in tree.items() for rp, c in t.items()]
    return spark.createDataFrame(rows, schemas.FILES)


def manifest_df(spark, dirs):
    return spark.createDataFrame([(i + 1, f"name-{d}", d, "git") for i, d in enumerate(dirs)], schemas.MANIFEST)


def test_flatten_two_files(spark):
    files = files_df(spark, {"s": {"root.txt": b"hello root\n", "src/module/nested.md": b"hello nested\n"}})
    items, _ = process.flatten_files(files, manifest_df(spark, ["s"]))
    got = {r["filename"]: bytes(r["content"]) for r in items.collect()}
    assert got == {"root.txt": b"hello root\n", "src__module__nested.md": b"hello nested\n"}


def test_flatten_skips_build_dirs(spark):
    tree = {"s": {"keepme.txt": b"k", "src/ok.rs": b"o", ".git/info/config": b"", "target/deep/temp.obj": b""}}
    items, _ = process.flatten_files(files_df(spark, tree), manifest_df(spark, ["s"]))
    assert sorted(r["filename"] for r in items.collect()) == ["keepme.txt", "src__ok.rs"]


def test_flatten_collisions_and_duplicate_sources(spark):
    tree = {"s": {"a/b__c": b"1", "a__b/c": b"2"}}
    man = spark.createDataFrame([(1, "n", "s", "git"), (2, "n", "s", "git")], schemas.MANIFEST)
    items, _ = process.flatten_files(files_df(spark, tree), man)
    got = sorted((r["pos"], r["filename"]) for r in items.collect())
    assert got == [(1, "a__b__c"), (1, "a__b__c"), (2, "a__b__c"), (2, "a__b__c")]


def test_readme_item(spark):
    tree = {"s": {"README.md": b"# Test\nHello world!\n"}, "t": {"docs/README.md": b"x", "readme.md": b"y"}}
    items, rejects = process.readme_files(files_df(spark, tree), manifest_df(spark, ["s", "t", "u"]))
    rows = items.collect()
    assert len(rows) == 1 and rows[0]["filename"] == "README.pdf"
    content = bytes(rows[0]["content"])
    assert content == PDF_STUB and len(content) > 100 and content.startswith(b"%PDF")
    assert rows[0]["source_text"] == "# Test\nHello world!\n"
    assert sorted((r["source_dir"], r["reason"]) for r in rejects.collect()) == [("t", "no_readme"), ("u", "no_readme")]


def test_kind_registry():
    assert process.canonical_kind("readme2pdf") == ("ReadmeToPDF", True)
    assert process.canonical_kind("flatten_files") == ("FlattenFiles", True)
    assert process.canonical_kind("Other") == ("FlattenFiles", False)


def test_wiki_source_needs_top_level_readme_page(spark):
    from quire.operators import wiki

    def page(title, anc=()):
        return {"title": title, "body": {"storage": {"value": "<p>r</p>"}}, "ancestors": [{"title": a} for a in anc]}

    rows = [("w1", 0, 200, True, [page("README"), page("x")]), ("w2", 0, 200, True, [page("README", ["Home"])])]
    batches = spark.createDataFrame(rows, schemas.CONTENT_BATCHES)
    files, _ = wiki.wiki_files(batches, batch_size=100)
    items, rejects = process.readme_files(files, manifest_df(spark, ["w1", "w2"]))
    assert [r["source_dir"] for r in items.collect()] == ["w1"]
    assert [(r["source_dir"], r["reason"]) for r in rejects.collect()] == [("w2", "no_readme")]


def test_custom_processor(spark):
    from pyspark.sql import functions as F

    def only_markdown(files, manifest):
        items, rejects = process.flatten_files(files.where(F.col("rel_path").endswith(".md")), manifest)
        return items, rejects

    process.register_processor("MarkdownOnly", only_markdown)
    files = files_df(spark, {"s": {"a.md": b"x", "b.txt": b"y"}})
    items, _ = process.process(files, manifest_df(spark, ["s"]), "MarkdownOnly")
    assert [r["filename"] for r in items.collect()] == ["a.md"]
    assert process.canonical_kind("MarkdownOnly") == ("MarkdownOnly", True)
