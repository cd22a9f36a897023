"""Small helpers of the operators."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ..session import checkpoint_root


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its
    lineage there.  Spark removes the files after the last reference when
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def with_field(schema: StructType, name: str, kind: DataType) -> StructType:
    """A copy of ``schema`` with one more column."""
    return StructType([*schema.fields, StructField(name, kind)])


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], share: int = 500) -> DataFrame:
    """Left join of ``left`` with ``right``, whose ``keys`` are unique and not
    null, without a hot key: keys that hold more than one row in ``share`` of
    ``left`` are fewer than ``share``, so their rows of ``right`` are
    broadcast; no key that is left to the exchange holds more than that.
    ``left`` is read twice, so it should be a settled table."""
    hot = fresh_name(left, "__hot")
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias(hot))
    total = left.agg(F.count(F.lit(1)).alias("n"))
    heavy = counts.filter(F.col(hot) * share > total.scalar()).select(*keys)
    known = F.broadcast(heavy.join(right, keys, "left").withColumn(hot, F.lit(True)))
    more = [c for c in right.columns if c not in keys]
    marked = left.join(known, keys, "left")
    direct = marked.filter(F.col(hot)).drop(hot)
    rest = marked.filter(F.col(hot).isNull()).drop(hot, *more).join(right, keys, "left")
    return direct.unionByName(rest)


def tidy(run):
    """``run`` for ``mapInArrow``, giving freed memory back at its end: Python
    workers live on between stages, and what their allocators hold back counts
    as the executor's."""
    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
        if trim is not None:
            trim(0)

    return wrapped
