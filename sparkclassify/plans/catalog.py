"""Registry of the named queries and their oracle SQL statements.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the given tables.
The SQL (DuckDB dialect, tables registered as views) is written
independently of the Spark code and must give the same rows; queries
whose values SQL cannot reproduce (model training) register no SQL and
are checked by row counts and by tests instead.

Computed doubles (logarithms, sums in engine-specific order) can differ
between two engines in the last bit, so the columns named in ``round6``
are rounded to 6 decimal places on both sides of the comparison: in the
registered query's output and around its SQL.  The library functions
themselves keep full precision.
"""

from __future__ import annotations

import functools
import importlib

from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE: dict = {}


def _rounded_query(fn, cols):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        df = fn(spark, sf_dir)
        return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c)
                           for c in df.columns])
    return run


def _rounded_sql(sql, cols):
    repl = ", ".join(f"round({c}, 6) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"


_MODULES = ("text_queries", "table_queries", "feature_queries",
            "metric_queries", "model_queries", "jobs")


def register(name: str, sql: str | None = None, round6=()):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        cols = tuple(round6)
        QUERIES[name] = _rounded_query(fn, cols) if cols else fn
        if sql is not None:
            ORACLE[name] = _rounded_sql(sql, cols) if cols else sql
        return fn
    return deco


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"{__package__}.{m}")


def all_queries() -> dict:
    _load()
    return dict(QUERIES)


def all_oracle_sql() -> dict:
    _load()
    return dict(ORACLE)
