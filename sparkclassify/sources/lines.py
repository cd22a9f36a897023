"""Line sources: one record per text line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, column: str = "text") -> DataFrame:
    """Text files -> one row per line (Hadoop line splitting: ``\\n``,
    ``\\r\\n`` and ``\\r``; no empty row after a final newline).  Splittable,
    so large files are read by many tasks."""
    return spark.read.text(path).withColumnRenamed("value", column)


def explode_lines(df: DataFrame, text_col: str = "text", line_col: str = "line",
                  number_col: str | None = "line_no", keep=()) -> DataFrame:
    """Split a stored text column again on newline and explode it.

    Each output row keeps the columns in ``keep`` (e.g. the document id),
    so that lines remain attributable to their document; ``number_col``
    (0-based position) makes ``(id, line_no)`` a key.  The explode is local
    to the task holding the document: no shuffle.  A null text keeps one
    row with a null line (and number); dropping nulls is the caller's decision.
    """
    parts = F.split(F.col(text_col), "\n")
    keep_cols = [F.col(k) for k in keep]
    if number_col:
        return df.select(*keep_cols, F.posexplode_outer(parts).alias(number_col, line_col))
    return df.select(*keep_cols, F.explode_outer(parts).alias(line_col))


def write_lines(df: DataFrame, path: str, text_col: str = "text") -> None:
    df.select(F.col(text_col).alias("value")).write.mode("errorifexists").text(path)
