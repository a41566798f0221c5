import json

import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.operators import wiki
from quire.sources import landed


def page(title, ancestors=(), body="<p>x</p>"):
    return {"title": title, "body": {"storage": {"value": body}}, "ancestors": [{"title": a} for a in ancestors]}


def batches_df(spark, specs, source="s"):
    """specs: list of (start, n_results or None for missing results, status, parsed)."""
    rows = []
    for start, n, status, parsed in specs:
        results = None if n is None else [page(f"p{start + i}") for i in range(n)]
        rows.append((source, start, status, parsed, results))
    return spark.createDataFrame(rows, schemas.CONTENT_BATCHES)


def kept_titles(spark, specs, batch, limit=None):
    pages = wiki.cap_pages(wiki.pages_of(wiki.kept_batches(batches_df(spark, specs), batch), batch), limit)
    return [r["title"] for r in pages.orderBy("ordinal").collect()], pages


def test_stop_after_short_batch(spark):
    titles, _ = kept_titles(spark, [(0, 4, 200, True), (4, 4, 200, True), (8, 2, 200, True), (12, 4, 200, True)], 4)
    assert titles == [f"p{i}" for i in range(8)] + ["p8", "p9"]


def test_stop_before_failed_batch(spark):
    specs = [(0, 4, 200, True), (4, 4, 500, True), (8, 4, 200, True)]
    titles, _ = kept_titles(spark, specs, 4)
    assert titles == ["p0", "p1", "p2", "p3"]
    titles, _ = kept_titles(spark, [(0, 4, 200, True), (4, 4, 200, False)], 4)
    assert titles == ["p0", "p1", "p2", "p3"]
    rej = wiki.rejected_batches(batches_df(spark, specs), 4).collect()
    assert [(r["reason"], r["detail"]) for r in rej] == [("page_batch_failed", "start=4")]


def test_empty_or_missing_results(spark):
    assert kept_titles(spark, [(0, 0, 200, True), (4, 4, 200, True)], 4)[0] == []
    assert kept_titles(spark, [(0, None, 200, True), (4, 4, 200, True)], 4)[0] == []


def test_missing_batch_ends_paging(spark):
    assert kept_titles(spark, [(0, 4, 200, True), (8, 4, 200, True)], 4)[0] == ["p0", "p1", "p2", "p3"]
    assert kept_titles(spark, [(4, 4, 200, True)], 4)[0] == []


@pytest.mark.parametrize("raw,limit,n", [("15", 15, 15), ("0", 0, 0), (None, None, 40), ("x", None, 40), ("+5", 5, 5), ("-1", None, 40)])
def test_page_cap(spark, raw, limit, n):
    assert wiki.parse_page_limit(raw) == limit
    specs = [(s, 10, 200, True) for s in range(0, 40, 10)] + [(40, 0, 200, True)]
    titles, _ = kept_titles(spark, specs, 10, limit)
    assert titles == [f"p{i}" for i in range(n)]


def test_oversized_batch_keeps_exact_order(spark):
    # A response longer than the batch size shifts every later ordinal.
    specs = [(0, 6, 200, True), (4, 4, 200, True), (8, 1, 200, True)]
    rows = []
    for start, n, status, parsed in specs:
        rows.append(("s", start, status, parsed, [page(f"b{start}_{i}") for i in range(n)]))
    df = spark.createDataFrame(rows, schemas.CONTENT_BATCHES)
    pages = wiki.pages_of(wiki.kept_batches(df, 4), 4)
    got = [(r["title"], r["ordinal"]) for r in pages.orderBy("ordinal").collect()]
    assert [o for _, o in got] == list(range(11))
    assert got[6][0] == "b4_0" and got[10][0] == "b8_0"
    capped = wiki.cap_pages(pages, 8).count()
    assert capped == 8


def test_last_write_wins_and_names(spark):
    rows = [("s", 0, 200, True, [page("Q: A/B?", ["Home", None]), page("T", ["A"], "<h1>one</h1>"),
                                 page("T", ["A"], "<h1>two</h1>")])]
    df = spark.createDataFrame(rows, schemas.CONTENT_BATCHES)
    files, rejects = wiki.wiki_files(df, batch_size=100)
    got = {r["rel_path"]: bytes(r["content"]).decode() for r in files.collect()}
    assert got == {"Home__Q_ A_B.md": "\n\nx\n", "A__T.md": "\n# two\n"}
    assert rejects.count() == 0


def test_long_page_name_keeps_its_body(spark):
    rows = [("s", 0, 200, True, [page("x" * 300), page("ok")])]
    files, rejects = wiki.wiki_files(spark.createDataFrame(rows, schemas.CONTENT_BATCHES), batch_size=100)
    assert sorted((r["rel_path"], bytes(r["content"])) for r in files.collect()) == [("ok.md", b"\n\nx\n"), ("x" * 300 + ".md", b"\n\nx\n")]
    assert rejects.count() == 0


def test_misplaced_batch_is_rejected_not_dropped(spark):
    rej = wiki.rejected_batches(batches_df(spark, [(0, 2, 200, True), (3, 2, 200, True), (-2, 1, 200, True)]), 2).collect()
    assert sorted((r["reason"], r["detail"]) for r in rej) == [("page_batch_misplaced", "start=-2"), ("page_batch_misplaced", "start=3")]


def test_retried_response_counts_once(spark):
    specs = [(0, 2, 200, True), (2, 2, 503, True), (2, 2, 200, True), (2, 2, 200, True), (4, 1, 200, True)]
    titles, pages = kept_titles(spark, specs, 2)
    assert titles == ["p0", "p1", "p2", "p3", "p4"]
    assert sorted(r["ordinal"] for r in pages.collect()) == [0, 1, 2, 3, 4]
    assert wiki.rejected_batches(batches_df(spark, specs), 2).count() == 0


@pytest.mark.parametrize("limit,n", [(2, 0), (3, 1), (None, 1)])
def test_failure_past_the_cap_is_no_reject(spark, limit, n):
    specs = [(0, 2, 200, True), (2, 2, 500, True)]
    assert wiki.rejected_batches(batches_df(spark, specs), 2, limit).count() == n


def test_listing_past_the_variant_size(spark):
    body = F.concat(F.lit('{"results":[{"title":"big","body":{"storage":{"value":"'), F.repeat(F.lit("x"), 2**20), F.lit('"}}}'),
                    F.repeat(F.concat(F.lit(',{"title":"p","pad":"'), F.repeat(F.lit("y"), 2**20), F.lit('"}')), 135), F.lit("]}"))
    row = spark.range(1).select(F.lit("s").alias("source_dir"), F.lit(0).alias("start"), F.lit(200).alias("status"), body.alias("body"))
    got = landed.content_batches(row).select("parsed", F.size("results").alias("n")).first()
    assert (got["parsed"], got["n"]) == (True, 136)


def test_landed_json_strict_titles(spark, tmp_path):
    lines = [
        {"source_dir": "s", "status": 200, "body": json.dumps({"key": "S"})},
        {"source_dir": "s", "start": 0, "status": 200, "body": json.dumps({"results": [
            {"title": "a", "body": {"storage": {"value": "<p>A</p>"}}, "ancestors": [{"title": "Home"}, {"id": 1}]},
            {"title": 5},
            {"x": 1, "ancestors": "nope"},
        ]})},
        {"source_dir": "t", "start": 0, "status": 200, "body": "not json"},
        {"source_dir": "u", "start": 0, "status": 200, "body": json.dumps({"results": 3})},
    ]
    p = tmp_path / "landed.jsonl"
    p.write_text("\n".join(json.dumps(x) for x in lines))
    resp = landed.read_responses(spark, str(p))
    batches = landed.content_batches(resp)
    by = {r["source_dir"]: r for r in batches.collect()}
    assert by["t"]["parsed"] is False and by["u"]["parsed"] is True and by["u"]["results"] == []
    titles = [x["title"] for x in by["s"]["results"]]
    assert titles == ["a", None, None]
    files, _ = wiki.wiki_files(batches, landed.space_documents(resp), batch_size=100)
    names = sorted(r["rel_path"] for r in files.where(F.col("source_dir") == "s").collect())
    assert names == ["Home__a.md", "space.json", "untitled.md"]
    landed.check_spaces(landed.space_documents(resp))


def test_failed_space_raises(spark):
    df = spark.createDataFrame([("s", None, 404, "nope")], schemas.LANDED_RESPONSES)
    with pytest.raises(landed.SpaceFetchError):
        landed.check_spaces(landed.space_documents(df))


def test_undecodable_space_body(spark):
    df = spark.createDataFrame([("s", None, 200, None)], schemas.LANDED_RESPONSES)
    assert [r["body"] for r in landed.space_documents(df).collect()] == ["<Failed to decode response body>"]


def test_batch_without_status_counts_as_failed(spark):
    titles, _ = kept_titles(spark, [(0, 4, 200, True), (4, 4, None, True), (8, 4, 200, True)], 4)
    assert titles == ["p0", "p1", "p2", "p3"]


def test_space_without_status_fails(spark):
    df = spark.createDataFrame([("s", None, None, "{}")], schemas.LANDED_RESPONSES)
    with pytest.raises(landed.SpaceFetchError):
        landed.check_spaces(landed.space_documents(df))
