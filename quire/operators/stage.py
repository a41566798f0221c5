"""Materialise intermediate results in the shared checkpoint folder.

Used where a result is read more than once (a decision, then the data) or
must stay fixed across retries; both forms cut the lineage, so a lost
executor does not force recomputing everything upstream.

* :func:`materialize` — ``checkpoint()`` for key-sized results (ids, stop
  points, counts, catalogues): cheapest to write and read back.
* :func:`land` — a parquet table for results that carry contents (pages,
  items): columnar and compressed, so large payloads stay cheap.

Both write under the session's ``spark.checkpoint.dir``; the folders this
process writes are tracked and removed by :func:`quire.session.cleanup_staging`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quire.session import ensure_checkpoint_dir, staging_path, track_staged


def materialize(df: DataFrame, label: str = "") -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    done = df.checkpoint(eager=True)
    try:
        path = done._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if path.isDefined():
            track_staged(path.get())
    except Exception:  # tracking is best effort; the folder is in the checkpoint dir anyway
        pass
    return done


def land(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
