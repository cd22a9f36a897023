"""Text operators on DataFrames: clean, tokenise, stop words, explode.

All are projections with built-in expressions; none shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH_STOP_WORDS
from ..functions.text import clean_text, tokens, without_stop_words


def clean_column(df: DataFrame, in_col: str, out_col: str | None = None,
                 keep_digits: bool = True) -> DataFrame:
    """Strip punctuation, trim (Java semantics), lower case."""
    return df.withColumn(out_col or in_col, clean_text(in_col, keep_digits))


def tokenize(df: DataFrame, in_col: str, out_col: str) -> DataFrame:
    """The ML ``Tokenizer`` as a native expression (see
    ``functions.text.tokens``).  Like the Tokenizer, a null input is an
    error, so callers drop nulls first."""
    checked = F.when(F.col(in_col).isNull(),
                     F.raise_error(F.lit(f"tokenize: null in column {in_col}")))
    return df.withColumn(out_col, checked.otherwise(tokens(in_col)))


def remove_stop_words(df: DataFrame, in_col: str, out_col: str,
                      stop_words=ENGLISH_STOP_WORDS,
                      case_sensitive: bool = False) -> DataFrame:
    return df.withColumn(out_col, without_stop_words(in_col, stop_words, case_sensitive))


def explode_elements(df: DataFrame, keep, array_col, out_col: str) -> DataFrame:
    """``explode`` of an array whose elements are never null, without the
    filter Catalyst infers for a plain ``explode`` (``size(array) > 0``).
    Predicate pushdown copies that filter, with the whole expression that
    builds the array (cleaning, tokenising, stop words), below projections
    and exchanges, so the text work would run twice, the first time before
    the exchange.  ``explode_outer`` plus a null filter on the generated
    column gives the same rows and keeps the work after the exchange."""
    out = df.select(*[F.col(k) for k in keep], F.explode_outer(array_col).alias(out_col))
    return out.where(F.col(out_col).isNotNull())


def explode_terms(df: DataFrame, tokens_col: str, term_col: str = "term",
                  keep=("label",)) -> DataFrame:
    """One row per (kept columns, term)."""
    return explode_elements(df, keep, tokens_col, term_col)


def term_counts(df: DataFrame, tokens_col: str, by=("label",),
                term_col: str = "term") -> DataFrame:
    """Occurrences of each term per group.  The aggregate is partial on the
    map side, so a very frequent term is summed inside each task before
    the shuffle and cannot pile up in one reducer."""
    exploded = explode_terms(df, tokens_col, term_col, keep=by)
    return (exploded.groupBy(*by, term_col)
                    .agg(F.count(F.lit(1)).alias("n_occurrences")))
