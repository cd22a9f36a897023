"""Reproducible hashes as Column expressions.

* ``murmur3`` buckets are ``pmod(hash(term), n)``: Spark SQL's ``hash`` is
  Murmur3 (seed 42) over the UTF-8 bytes, the function Spark 2.x's
  ``HashingTF`` used, so these buckets equal the ones recorded by the
  original jobs.  ``pyspark.ml``'s ``HashingTF`` in Spark 3+ hashes
  differently.
* ``md5`` buckets use the first 32 bits of the MD5 digest; any SQL engine
  can compute them, which is what the DuckDB oracle needs.

The split hash is md5 based as well, so a row's side of a split depends on
its key and the seed only, never on partition layout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296


def md5_u32(c: Column) -> Column:
    """First 32 bits of md5(c) as a non-negative bigint."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")


def term_bucket(c, num_buckets: int = 10000, algo: str = "murmur3") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if algo == "murmur3":
        return F.pmod(F.hash(col), F.lit(num_buckets)).cast("int")
    if algo == "md5":
        return F.pmod(md5_u32(col.cast("string")), F.lit(num_buckets)).cast("int")
    raise ValueError(f"unknown hash algorithm {algo!r}")


def split_key_hash(key_cols, seed: int) -> Column:
    """md5 of ``seed:key1:key2...`` -> [0, 2^32)."""
    parts = [F.lit(str(seed))] + [
        (F.col(k) if isinstance(k, str) else k).cast("string") for k in key_cols]
    return md5_u32(F.concat_ws(":", *parts))


def split_bounds(weights) -> list[int]:
    """Upper bounds (exclusive) in [0, 2^32] of each part after the first
    ``k - 1``; weights are normalised like ``randomSplit``."""
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(int(acc * TWO_POW_32))
    return bounds


def split_part(key_cols, weights, seed: int) -> Column:
    """Index of the part a row falls in (0-based, int)."""
    h = split_key_hash(key_cols, seed)
    bounds = split_bounds(weights)
    expr = None
    for i, b in enumerate(bounds):
        expr = (F.when(h < F.lit(b), F.lit(i)) if expr is None
                else expr.when(h < F.lit(b), F.lit(i)))
    last = F.lit(len(bounds))
    return last if expr is None else expr.otherwise(last)
