"""Session helpers: a local session for tests and benches, and the shared scratch folder.

Library operators never build a session; they take the caller's. Only tests,
``bench.py`` and command-line runs use :func:`local_session`.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "riskengine") -> SparkSession:
    """A ``local[N]`` session with AQE on, the UI off and a UTC session zone."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Small data on one machine: AQE may merge shuffle partitions, but never below
        # the core count, so every stage keeps all cores busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionNum",
                str(shuffle_partitions))
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("RISKENGINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only where none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3, ...);
    it is read, never replaced.  When it is unset, a local-mode session (tests,
    single-machine runs) gets a fresh ``mkdtemp`` folder; any other master gets an
    error, as a machine-local folder cannot serve a cluster.  Sessions without a ``SparkContext`` (Spark
    Connect) are answered from the configuration alone.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", None) or (sc.master if sc is not None else "")
        if not str(master).startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder (HDFS, S3, ...) "
                "that every executor can reach")
        configured = tempfile.mkdtemp(prefix="riskengine-ckpt-")
        if sc is None:
            try:
                spark.conf.set("spark.checkpoint.dir", configured)
            except Exception:  # noqa: BLE001 -- a static setting on some servers
                pass
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCRATCH: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for written tables.

    Its caller removes it with :func:`drop_scratch` after the last read.  A table that a
    returned, lazy result still reads has no such moment in the library: it is removed
    when the program ends, with whatever else is left.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.add(path)
    return path


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Remove scratch tables (paths from :func:`scratch_path`) through Spark's file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
        _SCRATCH.discard(path)


@atexit.register
def _sweep() -> None:
    spark = SparkSession.getActiveSession()
    try:
        if spark is not None:
            drop_scratch(spark, *list(_SCRATCH))
    except Exception:  # noqa: BLE001 -- the session is gone: its checkpoint folder's owner clears it
        pass


def materialize(df):
    """Write ``df`` once to the shared folder and return a table that reads it back.

    Used where one derived table feeds several jobs, so its upstream joins and shuffles
    run once.  Readers get column pruning, and the files survive the loss of any executor.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
