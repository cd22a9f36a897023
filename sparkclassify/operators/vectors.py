"""Vector assembly and label indexing (``pyspark.ml`` transformers)."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame


def assembler(cols, out_col: str = "features", handle_invalid: str = "error"):
    """Numeric columns -> one dense vector (row-wise, JVM side).  A null or
    NaN input fails the job, as ``toDouble`` did in the original loaders,
    unless ``handle_invalid`` says otherwise."""
    return VectorAssembler(inputCols=list(cols), outputCol=out_col,
                           handleInvalid=handle_invalid)


def assemble(df: DataFrame, cols, out_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    return assembler(cols, out_col, handle_invalid).transform(df)


def label_indexer(in_col: str, out_col: str = "label",
                  order: str = "frequencyDesc", handle_invalid: str = "error"):
    """Most frequent value -> 0.0; ties in frequency go alphabetically.
    An unseen value at transform time is an error by default.  Fitting
    counts the values with one distributed aggregate; only the distinct
    labels reach the driver."""
    return StringIndexer(inputCol=in_col, outputCol=out_col,
                         stringOrderType=order, handleInvalid=handle_invalid)


def index_labels(df: DataFrame, in_col: str, out_col: str = "label",
                 order: str = "frequencyDesc", fit_on: DataFrame | None = None):
    """Fit the indexer (on ``fit_on`` or ``df``) and apply it.  Returns
    ``(indexed_df, model)``."""
    model = label_indexer(in_col, out_col, order).fit(fit_on if fit_on is not None else df)
    return model.transform(df), model
