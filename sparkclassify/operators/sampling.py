"""Union of labelled sources and reproducible hash splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import split_part


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; duplicates are kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def with_split_part(df: DataFrame, key_cols, weights, seed: int,
                    part_col: str = "part") -> DataFrame:
    """Tag each row with the part it belongs to.

    ``randomSplit`` draws per partition, so which rows land where depends
    on partition layout and cannot be reproduced on another cluster or
    after an input is re-read.  Here the part is a function of the row key
    and the seed only; parts are disjoint and complete by construction.
    """
    return df.withColumn(part_col, split_part(key_cols, weights, seed))


def hash_split(df: DataFrame, key_cols, weights, seed: int) -> list[DataFrame]:
    """Split into ``len(weights)`` frames (lazily; each is a filter)."""
    tagged = with_split_part(df, key_cols, weights, seed, "__part")
    return [tagged.where(F.col("__part") == i).drop("__part")
            for i in range(len(weights))]
