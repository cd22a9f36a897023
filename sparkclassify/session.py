"""Session creation and the shared folder used to cut lineage.

The shared folder is whatever ``spark.checkpoint.dir`` names; it is read from
the running session and never written.  Only what cuts lineage needs it.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "sparkclassify", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    """Return the active session or build one with sensible defaults.

    ``master`` is only used when given (cluster submissions set it
    themselves).  The number of shuffle partitions is left to the caller:
    on a cluster it should be sized so that one partition of the largest
    shuffle fits in executor memory; AQE coalesces small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables: the one set on
    the context, or else the one ``spark.checkpoint.dir`` names."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        # getCheckpointDir returns a per-application sub folder.
        return root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError(
            "no shared folder: set spark.checkpoint.dir to a folder that the driver and all "
            "executors can reach, for instance get_spark(extra_conf={'spark.checkpoint.dir': ...})")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir()


_WRITTEN: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder for a written table; it
    lives until ``release_tables``."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/sparkclassify-{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def release_tables(spark: SparkSession) -> int:
    """Delete every table this process has written below the shared folder.
    To be called once results that read them have been consumed; returns how
    many there were."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _WRITTEN:
        path = hadoop.Path(_WRITTEN.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load_table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's parquet tables (column pruning and filter
    pushdown happen in the scan)."""
    return spark.read.parquet(table_path(sf_dir, name))


def materialize(df, name: str):
    """Write ``df`` to a new path below the shared folder and read it back:
    one job computes it, every later use reads the files, and the result no
    longer depends on the lineage that produced it (it survives executor
    loss).  For derived tables read more than once."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
