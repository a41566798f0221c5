"""Session construction and the few cluster settings the engine relies on."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job of the engine expects; a cluster may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows carry whole files; keep Arrow batches bounded in bytes, not just rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
}


# Spark's default for the last of them.
SPARK_BATCH_ROWS = "10000"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quire") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEMORY", "8g"))
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder used to cut lineage.

    On a cluster the folder must be named by ``spark.checkpoint.dir``; it is
    read from the session and never replaced.  Only a local-mode session
    without one (tests, benches) gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared folder is required on a cluster"
        )
    folder = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per application, so that a cluster needs no installed copy.

    Also bounds Arrow batches where the session has Spark's own default: rows
    carry whole texts, and a batch is held several times on its way.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == SPARK_BATCH_ROWS:
        spark.conf.set(rows, DEFAULT_CONF[rows])
    sc = spark.sparkContext
    if getattr(sc, "_quire_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="quire-ship-")) / "quire.zip"  # the driver serves it to executors
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._quire_shipped = True


_STAGED: list[str] = []


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the checkpoint folder for a materialised step."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/quire-staging/{label}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def track_staged(path: str) -> None:
    """Register a folder written by this process for :func:`cleanup_staging`."""
    _STAGED.append(path)


def cleanup_staging(spark: SparkSession | None = None) -> int:
    """Delete the staging folders this process created; returns how many.

    DataFrames read from them become unusable, so call it when the work is
    done (the engine also tries at interpreter exit).  Uses the Hadoop file
    system of each path, so it works for local, HDFS and object-store folders.
    """
    spark = spark or SparkSession.getActiveSession()
    if spark is None or not _STAGED:
        return 0
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    while _STAGED:
        path = _STAGED.pop()
        try:
            jpath = jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(conf).delete(jpath, True)
            done += 1
        except Exception:  # the folder may already be gone
            pass
    return done


@atexit.register
def _cleanup_at_exit() -> None:
    try:
        cleanup_staging()
    except Exception:
        pass
