import random

from pyspark.sql import functions as F

from quire.functions import naming
from tests import models


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_source_dir_names(spark):
    rows = [
        ("git", "https://github.com/o/r", "main", None, None),
        ("git", "https://github.com/o/r", "879e21e", None, None),
        ("git", "git@github.com:o/r.git", None, None, None),
        ("confluence", None, None, "https://dummy.atlassian.net/wiki", "DUMMY"),
        ("confluence", None, None, "https://dummy.atlassian.net/wiki//", "DUMMY"),
    ]
    schema = "type string, repo_url string, reference string, base_url string, space_key string"
    df = spark.createDataFrame(rows, schema).select(
        naming.source_dir("type", "repo_url", "reference", "base_url", "space_key").alias("d"),
        naming.logical_name("type", "repo_url", "base_url", "space_key").alias("n"),
    )
    got = [tuple(r) for r in df.collect()]
    assert got == [
        ("git_https___github.com_o_r_main", "https://github.com/o/r"),
        ("git_https___github.com_o_r_879e21e", "https://github.com/o/r"),
        ("git_git@github.com_o_r.git_main", "git@github.com:o/r.git"),
        ("confluence_https___dummy.atlassian.net_wiki_DUMMY", "https://dummy.atlassian.net/wiki:DUMMY"),
        ("confluence_https___dummy.atlassian.net_wiki_DUMMY", "https://dummy.atlassian.net/wiki//:DUMMY"),
    ]


def test_empty_reference_is_kept(spark):
    got = one(spark, naming.git_dir_name("u", "r"), [("x", "")], "u string, r string")
    assert got == ["git_x_"]


FLAT_CASES = [
    ("root.txt", "root.txt"),
    ("src/module/nested.md", "src__module__nested.md"),
    ("a/" + "b" * 177, "a__" + "b" * 177),
    ("a/" + "b" * 178, "b" * 178),
    ("d/" + "y" * 300, "y" * 300),
    ("é" * 60 + "/" + "é" * 59 + ".md", "é" * 59 + ".md"),
]


def test_flat_name_fixtures(spark):
    got = one(spark, naming.flat_name("p"), [(p,) for p, _ in FLAT_CASES], "p string")
    assert got == [want for _, want in FLAT_CASES]


def test_flat_name_deep_path(spark):
    path = "/".join(["verylongsegment"] * 50 + ["finalfilewithareallylongnametotestthelimit.txt"])
    (name,) = one(spark, naming.flat_name("p"), [(path,)], "p string")
    assert name == "__".join(["verylongsegment"] * 7 + ["finalfilewithareallylongnametotestthelimit.txt"])
    assert len(name.encode()) == 165 and len(name.encode()) <= 255


def test_flat_name_matches_model(spark):
    rnd = random.Random(7)
    alphabet = ["a", "bb", "ccc", "é", "日本", "x" * 40, "seg", "_", "."]
    paths = []
    for _ in range(800):
        n = rnd.randint(1, 25)
        paths.append("/".join("".join(rnd.choices(alphabet, k=rnd.randint(1, 6))) for _ in range(n)))
    got = one(spark, naming.flat_name("p"), [(p,) for p in paths], "p string")
    assert got == [models.flat_name(p) for p in paths]


def test_build_dirs(spark):
    paths = ["bin/target", ".git", "targets/x", ".github/ci.yml", ".gitignore", "pkg/__init__.py", "_p/q",
             "sub/target/y", "sub/.git/z", "target/deep/temp.obj", ".git/info/config", "keepme.txt"]
    got = one(spark, naming.in_build_dir("p"), [(p,) for p in paths], "p string")
    assert got == [models.in_build_dir(p) for p in paths]
    assert got == [False] * 7 + [True] * 4 + [False]


def test_page_stem_fixtures(spark):
    schema = "anc array<struct<title:string>>, title string"
    rows = [
        ([{"title": "Home"}, {"title": None}], "Q: A/B?"),
        ([], None),
        ([], "___x____y"),
        ([{"title": ".."}], "."),
        (None, "T"),
    ]
    col = naming.page_stem(naming.page_hierarchy("anc", "title"))
    got = one(spark, col, rows, schema)
    assert got == ["Home__Q_ A_B", "untitled", "x__y", "", "T"]


def test_page_stem_matches_model(spark):
    rnd = random.Random(3)
    chars = list('ab_./\\:*?"<>| é')
    cases = [["".join(rnd.choices(chars, k=rnd.randint(0, 12))) for _ in range(rnd.randint(1, 4))] for _ in range(500)]
    got = one(spark, naming.page_stem(F.col("parts")), [(c,) for c in cases], "parts array<string>")
    assert got == [models.page_stem(c) for c in cases]


def test_processor_kind(spark):
    kinds = ["ReadmeToPDF", "readme_to_pdf", "readme2pdf", "FlattenFiles", "flattenfiles", "flatten_files",
             "readmetopdf", "", None]
    got = one(spark, naming.processor_kind("k"), [(k,) for k in kinds], "k string")
    assert got == ["ReadmeToPDF"] * 3 + ["FlattenFiles"] * 6


def test_flat_name_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    tokens = list("ab_.-é\u0000\n日") + ["x" * 30, "__"]
    seg = st.lists(st.sampled_from(tokens), min_size=1, max_size=8).map("".join)
    paths = st.lists(seg, min_size=1, max_size=30).map("/".join)
    seen = []

    @settings(max_examples=300, deadline=None)
    @given(paths)
    def collect(p):
        seen.append(p)

    collect()
    got = one(spark, naming.flat_name("p"), [(p,) for p in seen], "p string")
    assert got == [models.flat_name(p) for p in seen]


def test_flat_name_nul_in_a_name_takes_the_exact_path(spark):
    # A table input may carry NUL, which the ASCII fast path uses as its separator mark.
    paths = ["x" * 100 + "/" + "y" * 40 + "\u0000\u0000" + "z" * 50 + "/w.txt", "a\u0000/" + "b" * 190]
    got = one(spark, naming.flat_name("p"), [(p,) for p in paths], "p string")
    assert got == [models.flat_name(p) for p in paths]
