"""K1, K2: the snapshot table — landed files of every source, partitioned by source folder.

Re-snapshotting a source replaces its folder entirely (K1): folders of the
refreshed sources that have files are overwritten dynamically, and those whose
new snapshot is empty are removed, so no stale file survives.  Sources not
being refreshed are never touched.  Contents are written once, dealt by folder
in pieces of even size.

A small table beside it keeps, for each folder, how many files it has and
between which times they were modified, so that a check by time (R3) reads the
folders alone that can hold an answer.  A folder's row goes before its files
change and returns afterwards; a folder without one is read in any case.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.operators.sizing import bounded_broadcast
from quire.operators.stage import materialize


def folders_table(table: str) -> str:
    return f"{table}_folders"


def ensure_snapshot_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    at = (lambda x: f" LOCATION '{location.rstrip('/')}/{x}'") if location else (lambda x: "")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schemas.SNAPSHOTS}) USING parquet PARTITIONED BY (source_dir){at('files')}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {folders_table(table)} ({schemas.SNAPSHOT_FOLDERS}) USING parquet{at('folders')}")


def _location(spark: SparkSession, table: str) -> str:
    return [r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect() if r["col_name"] == "Location"][0]


def _keep_folders(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Replace the folder rows; they are configuration-sized."""
    name = folders_table(table)
    fixed = spark.createDataFrame(rows.collect(), schemas.SNAPSHOT_FOLDERS)
    fixed.coalesce(1).write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def replace_snapshots(spark: SparkSession, table: str, files: DataFrame, refreshed: DataFrame) -> None:
    """Make ``table`` hold exactly ``files`` for every source folder in ``refreshed``.

    ``refreshed`` has one ``source_dir`` column (configuration-sized); files
    of other folders are left out, and those folders stay as they are.
    ``files`` may have a ``modified`` column.
    """
    ensure_snapshot_table(spark, table)
    refreshed = materialize(refreshed.select("source_dir").distinct(), "refreshed")
    others = spark.table(folders_table(table)).join(bounded_broadcast(refreshed), "source_dir", "left_anti")
    _keep_folders(spark, table, others)
    if "modified" not in files.columns:
        files = files.withColumn("modified", F.lit(None).cast("timestamp"))
    columns = [c for c in spark.table(table).columns]
    seen = Observation()
    # Dynamic overwrite replaces every folder it is given, so it is given the refreshed ones only.
    own = files.join(bounded_broadcast(refreshed), "source_dir", "left_semi").select(*columns)
    own = own.observe(seen, F.collect_set("source_dir").alias("folders"))  # as many as are configured
    root = _location(spark, table)
    own.hint("rebalance", "source_dir").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_dir").parquet(root)
    given = set(seen.get["folders"])
    emptied = [r["source_dir"] for r in refreshed.collect() if r["source_dir"] not in given]
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for folder in emptied:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/source_dir={utils.escapePathName(folder)}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    if given:
        at = spark.table(table).where(F.col("source_dir").isin(*given)).groupBy("source_dir")
        now = at.agg(F.count("*").alias("n_files"), F.min("modified").alias("first_modified"), F.max("modified").alias("last_modified"))
        _keep_folders(spark, table, spark.table(folders_table(table)).unionByName(now))


def read_snapshots(spark: SparkSession, table: str, source_dirs: list[str] | None = None) -> DataFrame:
    """Files of the given sources; the filter prunes to their partitions."""
    df = spark.table(table)
    if source_dirs is not None:
        df = df.where(F.col("source_dir").isin(*source_dirs))
    return df.select("source_dir", "rel_path", "length", "content", "modified")


def recent_files(spark: SparkSession, table: str, since: str | datetime.datetime) -> DataFrame:
    """Files changed at or after ``since`` (R3), read from the folders that have any.

    A file without a time counts as old.
    """
    from quire.operators.audit import recently_modified

    index = spark.table(folders_table(table))
    old = index.where(F.coalesce(F.col("last_modified") < F.lit(since).cast("timestamp"), F.lit(True)))
    held = spark.table(table).select("source_dir").distinct()  # from the partitions' names
    wanted = [r["source_dir"] for r in held.join(bounded_broadcast(old), "source_dir", "left_anti").collect()]
    return recently_modified(read_snapshots(spark, table, wanted), since)
