"""Plan shape checks: no Python evaluation in the hot path, bounded broadcasts, map-side combine."""

from quire.operators import bucket, process, stage, wiki
from quire.plans import derive
from quire.plans import queries as Q
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


PY_NODES = ("EvalPython", "MapInArrow", "MapInPandas", "InPandas", "PythonDataSource", "PythonMapInArrow")


def test_no_python_in_queries(spark, monkeypatch):
    """Neither in the plan a query returns nor in those it lands on the way."""
    plans = []
    for module in (stage, bucket, Q, derive, wiki):
        for name in ("land", "materialize"):
            if hasattr(module, name):
                monkeypatch.setattr(module, name, lambda df, *a, real=getattr(module, name): plans.append(plan(df)) or real(df, *a))
    for name, fn in Q.QUERIES.items():
        if name in ("tree_scan", "tree_links"):  # listing and reading files is Python, by design
            continue
        plans.clear()
        plans.append(plan(fn(spark, SF_SMALL)))
        assert not any(n in p for n in PY_NODES for p in plans), name


def test_flatten_broadcasts_the_manifest(spark):
    p = plan(Q.q_flatten_items(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_paging_stop_has_no_window_per_source(spark):
    batches = derive.page_batches(derive.table(spark, SF_SMALL, "pages"), 2)
    p = plan(wiki.kept_batches(batches, 2))
    assert "Window" not in p and "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_last_write_wins_shuffles_no_contents(spark):
    p = plan(Q.q_last_write_wins(spark, SF_SMALL))
    assert "SortAggregate" not in p and "Exchange hashpartitioning" not in p.split("Union")[1].split("HashAggregate")[0]


def test_scan_prunes_columns(spark):
    p = plan(Q.q_html_to_markdown(spark, SF_SMALL))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in p


def test_page_cap_is_a_filter_not_a_window(spark):
    p = plan(Q.q_page_cap(spark, SF_SMALL))
    # the cap is folded to a filter on the page's position; no Window operator anywhere
    assert "Window [" not in p and "WindowGroupLimit" not in p
    assert f"< {Q.PAGE_CAP})" in p


def test_item_load_broadcasts_sources_and_shuffles_contents_once(spark, monkeypatch):
    docs = derive.table(spark, SF_SMALL, "documents")
    manifest = derive.manifest_of(derive.doc_catalogue(docs))
    items, _ = process.flatten_files(derive.doc_files(docs).where("rel_path <> 'README.md'"), manifest)
    srcs = bucket.load_sources(manifest, 7)
    landed = []
    monkeypatch.setattr(bucket, "land", lambda df, label: landed.append(plan(df)) or stage.land(df, label))
    loaded = bucket.load_items(items, srcs)
    assert len(landed) == 1 and "BroadcastHashJoin" in landed[0] and "SortMergeJoin" not in landed[0]
    assert "REPARTITION" not in landed[0] and "rangepartitioning" not in landed[0]  # contents are landed where they were read
    assert plan(loaded).count("rangepartitioning") == 0


def test_broadcasts_are_bounded_in_rows_and_bytes(spark):
    from pyspark.sql import functions as F

    from quire.operators.sizing import bounded_broadcast

    left = spark.range(10).withColumnRenamed("id", "k")
    # Sizes are told apart by a hint alone here: the planner's own threshold is off.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("t"))
        wide = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), F.lit(1000)).alias("t"))
        for df, args, want in ((small, {}, True), (small, {"max_rows": 9}, False), (wide, {"max_bytes": 9000}, False), (wide, {"max_bytes": 20_000}, True)):
            assert ("BroadcastHashJoin" in plan(left.join(bounded_broadcast(df, **args), "k"))) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
