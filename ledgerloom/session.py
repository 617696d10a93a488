"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import getpass
import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerloom") -> SparkSession:
    """Session tuned for the reconciliation jobs.

    AQE re-plans joins from runtime sizes (a dimension that turns out small is
    broadcast; a skewed partition is split) and coalesces the many small
    shuffle partitions a store-day grain produces.
    """
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("SPARK_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.parquet.filterPushdown", "true")
        # prune the big side of a selective join before its shuffle
        .config("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def session_key(spark: SparkSession) -> str:
    """Identity of the running application (cache keys per session)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def _master(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.master
    except Exception:
        return spark.conf.get("spark.master", "")


def _set_checkpoint(spark: SparkSession, path: str) -> None:
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # the setting is enough where no SparkContext is exposed
        pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The setting is read from the session; only when it is unset (local runs
    and tests) is a folder chosen here: ``$LEDGERLOOM_CHECKPOINT_DIR`` or a
    per-user folder under /tmp, stable across local sessions so loaded tables
    are reused.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        _set_checkpoint(spark, current)
        return current
    if not _master(spark).startswith("local"):
        # executors on other machines cannot see a local folder
        raise ValueError("set spark.checkpoint.dir to a folder on shared storage")
    path = os.environ.get("LEDGERLOOM_CHECKPOINT_DIR") or os.path.join(
        tempfile.gettempdir(), f"ledgerloom-checkpoint-{getpass.getuser()}")
    os.makedirs(path, exist_ok=True)
    spark.conf.set("spark.checkpoint.dir", path)
    _set_checkpoint(spark, path)
    return path


def _file_system(spark: SparkSession, path: str):
    """(Hadoop path, its own file system): local, HDFS or an object store."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence of a file on the path's own file system."""
    hpath, fs = _file_system(spark, path)
    return fs.exists(hpath)


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of every file at or under ``path``,
    ordered; nothing where it does not exist."""
    hpath, fs = _file_system(spark, path)
    if not fs.exists(hpath):
        return []
    found, files = [], fs.listFiles(hpath, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), int(f.getLen()), int(f.getModificationTime())))
    return sorted(found)
