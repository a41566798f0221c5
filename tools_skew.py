"""Skew check: one source holds a third of all rows; no task may hold most of a stage.

Builds skewed inputs from the given tables (documents replicated with fresh
ids; a third of them moved into source ``src0``; pages replicated with a third
on one host), runs the main plans with AQE partition coalescing off (so tiny stages are
not packed into one task), and prints, per stage, the largest share of
shuffled records any one task read.

Usage: python tools_skew.py [sf_dir] [copies]
"""

import sys
import time

from pyspark.sql import functions as F

from quire.operators import bucket, process, report, wiki
from quire.plans import derive
from quire.session import cleanup_staging, local_session


def skewed_documents(docs, copies):
    rep = docs.crossJoin(docs.sparkSession.range(copies).withColumnRenamed("id", "copy"))
    n = docs.agg(F.max("doc_id")).first()[0] + 1
    rep = rep.withColumn("doc_id", F.col("doc_id") + F.col("copy") * F.lit(n))
    hot = (F.col("doc_id") % 3) == 0
    return rep.withColumn("source", F.when(hot, F.lit("src0")).otherwise(F.col("source"))).drop("copy")


def skewed_pages(pages, copies):
    rep = pages.crossJoin(pages.sparkSession.range(copies).withColumnRenamed("id", "copy"))
    n = pages.agg(F.max("page_id")).first()[0] + 1
    rep = rep.withColumn("page_id", F.col("page_id") + F.col("copy") * F.lit(n))
    hot = (F.col("page_id") % 3) == 0
    url = F.when(hot, F.regexp_replace("url", "://[^/]+", "://hot.example.com")).otherwise(F.col("url"))
    return rep.withColumn("url", url).drop("copy")


def stage_shares(spark, group):
    sc = spark.sparkContext
    store = sc._jsc.sc().statusStore()
    out = []
    for job in sc.statusTracker().getJobIdsForGroup(group):
        info = sc.statusTracker().getJobInfo(job)
        for sid in info.stageIds if info else []:
            try:
                tasks = store.taskList(sid, 0, 100_000)
            except Exception:
                continue
            recs = []
            for j in range(tasks.size()):
                m = tasks.apply(j).taskMetrics()
                if m.isDefined():
                    tm = m.get()
                    recs.append(tm.shuffleReadMetrics().recordsRead())
            total = sum(recs)
            if len(recs) >= 2 and total >= 1000:
                si = sc.statusTracker().getStageInfo(sid)
                out.append((sid, (si.name if si else "")[:40], len(recs), total, max(recs) / total))
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 6
    spark = local_session(8, 16)
    # Show the raw shuffle distribution: with coalescing on, AQE packs a tiny
    # stage into one task by size (right for small data, but it hides the split).
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("skew", "skew check")
    docs = skewed_documents(derive.table(spark, sf, "documents"), copies)
    pages = skewed_pages(derive.table(spark, sf, "pages"), copies)
    t0 = time.time()
    manifest = derive.manifest_of(derive.doc_catalogue(docs))
    items, _ = process.flatten_files(derive.doc_files(docs), manifest)
    srcs = bucket.load_sources(manifest, 7)
    loaded = bucket.load_items(items, srcs)
    rep = report.sync_report(bucket.source_table(srcs), loaded)
    rep.write.format("noop").mode("overwrite").save()
    files, _ = wiki.wiki_files(derive.page_batches(pages, 2), derive.page_spaces(pages), 2)
    files.write.format("noop").mode("overwrite").save()
    hot_share = loaded.where(F.col("external_source_id") == srcs.where("external_source_name like '%src0'")
                             .first()["external_source_id"]).count() / loaded.count()
    print(f"items {loaded.count()}, hot source share {hot_share:.2f}, seconds {time.time() - t0:.1f}")
    worst = sorted(stage_shares(spark, "skew"), key=lambda r: -r[4])
    print("shuffle-reading stages (scans of the one-file inputs are left out)")
    print("stage | name | tasks | shuffle records | largest task share")
    for r in worst[:12]:
        print(f"{r[0]} | {r[1]} | {r[2]} | {r[3]} | {r[4]:.2f}")
    cleanup_staging(spark)


if __name__ == "__main__":
    main()
