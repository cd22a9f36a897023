"""Partitioning helpers."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..session import materialize


@dataclass(frozen=True)
class FitLayout:
    """How the rows of a fit lie: hash partitions of the key, in key order.

    Tree bagging draws per partition, so a forest depends on the number of
    partitions.  It is ``partitions`` if that is given, else it follows from
    the number of rows alone: enough partitions that none is meant to hold more
    than ``rows_per_partition``.  Neither the cluster nor the files the rows
    come from matter, and no partition grows with the data.
    """
    rows_per_partition: int = 1 << 16
    partitions: int | None = None

    def count(self, rows: int) -> int:
        return self.partitions or max(1, -(-rows // self.rows_per_partition))


def by_key(df: DataFrame, keys, num_partitions: int | None = None) -> DataFrame:
    """Hash-partition rows by ``keys``; later aggregates and windows keyed by
    a superset of them find their input clustered.  The partition count
    defaults to ``spark.sql.shuffle.partitions``; AQE may coalesce."""
    cols = [keys] if isinstance(keys, str) else list(keys)
    if num_partitions:
        return df.repartition(num_partitions, *cols)
    return df.repartition(*cols)


def spread(df: DataFrame, keys, min_partitions: int | None = None) -> DataFrame:
    """Hash-partition by ``keys`` only when the input has fewer partitions
    than the cluster has task slots.

    A scan of a few large files (or one row group) yields a handful of
    partitions, and row-wise text work after it would run in that many
    tasks.  On a real table the scan already has thousands of splits and
    this is a no-op (no shuffle).  Checking the partition count plans the
    scan but runs no job.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    cols = [keys] if isinstance(keys, str) else list(keys)
    return df.repartition(want, *cols)


def fit_table(df: DataFrame, key: str, layout: FitLayout = FitLayout()) -> DataFrame:
    """A feature table for iterative fits: computed once into the shared
    folder, then read in one layout (see ``FitLayout``), so that a fit is the
    same on any cluster and for any layout of the input.  Rows of one key stand
    in the order of their other columns; the number of partitions can be read
    from the result (``layout_of``)."""
    written = materialize(df, "features")
    rest = [c for c in written.columns if c != key]
    return written.repartition(layout.count(written.count()), key).sortWithinPartitions(key, *rest)


def layout_of(df: DataFrame) -> int:
    """Number of partitions of a ``fit_table``; plans it, runs no job."""
    return df.rdd.getNumPartitions()


@contextmanager
def kept(df: DataFrame):
    """``df`` persisted while a fit passes over it many times."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
