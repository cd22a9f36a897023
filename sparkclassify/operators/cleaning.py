"""Projections, filters and cleaning of tabular rows (row-wise, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_missing(df: DataFrame, cols, marker: str = "?",
                 drop_nulls: bool = False) -> DataFrame:
    """Drop rows whose field equals the missing marker.

    SQL three-valued logic would silently drop nulls too (``null != '?'``
    is null); nulls are kept unless ``drop_nulls`` is set, so that null
    handling stays an explicit, separate decision.
    """
    cond = F.lit(True)
    for c in cols:
        keep = F.col(c).isNull() | (F.col(c) != F.lit(marker))
        if drop_nulls:
            keep = F.col(c).isNotNull() & (F.col(c) != F.lit(marker))
        cond = cond & keep
    return df.where(cond)


def drop_nulls(df: DataFrame, subset) -> DataFrame:
    """``na.drop(subset)``: rows null in any named column go; empty strings
    stay."""
    return df.na.drop(how="any", subset=list(subset))


def cast_numeric(df: DataFrame, cols, strict: bool = True,
                 to: str = "double") -> DataFrame:
    """String -> number.  ``strict`` fails the job on a bad value, like
    ``toDouble`` did, whatever the session's ANSI setting; otherwise bad
    values become null (``try_cast``).  Nulls stay null either way."""
    out = df
    for c in cols:
        src = F.col(c)
        value = src.try_cast(to)
        if strict:
            bad = src.isNotNull() & value.isNull()
            value = F.when(bad, F.raise_error(F.concat(
                F.lit(f"cast_numeric: not a {to} in column {c}: "), src))).otherwise(value)
        out = out.withColumn(c, value)
    return out


def with_label(df: DataFrame, value: float, label_col: str = "label") -> DataFrame:
    """A constant label for every row of one source."""
    return df.withColumn(label_col, F.lit(float(value)))


def score_label_pairs(df: DataFrame, prediction_col: str = "prediction",
                      label_col: str = "label") -> DataFrame:
    """``(prediction, label)`` pairs as doubles; rows where either is null
    are skipped, like the partial-function ``collect`` on ``Row(Double,
    Double)``."""
    return (df.select(F.col(prediction_col).cast("double").alias("prediction"),
                      F.col(label_col).cast("double").alias("label"))
              .where(F.col("prediction").isNotNull() & F.col("label").isNotNull()))
