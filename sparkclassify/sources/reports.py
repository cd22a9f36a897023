"""Console-style sinks turned into DataFrames: preview, counts, schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_columns(df: DataFrame, *names: str) -> DataFrame:
    """``toDF(names...)``: positional renaming."""
    return df.toDF(*names)


def preview(df: DataFrame, n: int = 20, order_by=None) -> DataFrame:
    """``show(n)`` / ``take(n)`` made deterministic: the first ``n`` rows
    by ``order_by`` (all columns when not given).  The limit is the
    feature; Spark plans it as a top-k (``TakeOrderedAndProject``), each
    task keeps only ``n`` rows."""
    keys = order_by or df.columns
    return df.orderBy(*keys).limit(n)


def split_counts(df: DataFrame, part_col: str = "part") -> DataFrame:
    """Rows per split part, all parts in one job."""
    return df.groupBy(part_col).agg(F.count(F.lit(1)).alias("n_rows"))


def describe_schema(df: DataFrame) -> DataFrame:
    """``printSchema`` as rows: position, name, type, nullable, and the
    measured row and null counts (one aggregate over the table)."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(F.when(F.col(f"`{f.name}`").isNull(), 1)).alias(f"__nulls_{i}")
             for i, f in enumerate(fields)]
    counts = df.agg(*aggs)
    entries = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.lit(f.nullable).alias("nullable"),
                        F.col("__rows").alias("n_rows"),
                        F.col(f"__nulls_{i}").alias("n_nulls"))
               for i, f in enumerate(fields)]
    return counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
