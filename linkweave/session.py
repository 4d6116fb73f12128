"""Spark session helpers.

Library code never builds its own session: every operator takes DataFrames and
returns DataFrames. ``local_session`` exists for tests, the bench and the entry
file; on a cluster the caller's session (and its ``spark.checkpoint.dir``) is used.
"""

from __future__ import annotations

import gc
import os
import re
import tempfile
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Rows of a large table's shuffle that one task gets, and the most tasks that this asks for.
ROWS_PER_TASK, MOST_TASKS = 1_000_000, 10_000
#: Least time between two collections that ``discard`` asks for.
GC_SECONDS, _last_gc = 20.0, float("-inf")

# Settings every session of this library should carry; safe on a cluster too.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "linkweave") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LINKWEAVE_DRIVER_MEMORY", "16g"))
    )
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names it in ``spark.checkpoint.dir``.  Where it is unset, a local master (tests, the bench) gets a
    fresh scratch folder; on any other master that is an error, since executors would each write to their own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local_master(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="linkweave-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def is_local_master(master: str) -> bool:
    return re.fullmatch(r"local(\[.*\])?", master) is not None


@contextmanager
def wide_shuffles(spark: SparkSession, rows: int):
    """Inside, shuffles are dealt to a task for each ``ROWS_PER_TASK`` of ``rows`` if that is more than the session's number, so
    that a task's memory does not grow with the table (AQE joins small partitions again, and never splits those of an aggregate)."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(max(int(before), min(-(-rows // ROWS_PER_TASK), MOST_TASKS))))
        yield
    finally:
        spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df, name: str | None = None):
    """Write ``df`` once as parquet under the shared checkpoint folder and read
    it back: cuts the lineage, survives executor loss (files, not executor
    memory), and unlike ``checkpoint()`` computes the plan only once.  ``discard`` deletes it."""
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{name or 't'}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out.written_path = path
    return out


def discard(*tables) -> None:
    """Delete tables that ``materialize`` wrote and nothing reads any more, and let Spark's cleaner
    remove the shuffle files of finished queries (it acts when the driver's garbage is collected, here at most every
    ``GC_SECONDS``: a whole collection takes longer than many a small round)."""
    global _last_gc
    for table in tables:
        sc = table.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    if tables and time.monotonic() - _last_gc > GC_SECONDS:
        _last_gc = time.monotonic()
        gc.collect()
        tables[0].sparkSession.sparkContext._jvm.System.gc()
