"""Character statistics of documents: numeric features for the tabular jobs.

Each feature is a count over the whole text.  The counts are taken from the
UTF-8 bytes of a batch of rows at a time (Arrow): a character class is what
deleting its bytes takes away, a probe is found as bytes.  As string expressions
(``translate``, ``replace``) every class and probe was a pass of its own that
built the text anew.  Shares and rates are built-in expressions of the counts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# The character probes counted per document (a choice, nothing demands them).
CHAR_PROBES = ("ñ", "ß", "ç", "é", "è", "ü", "ö", "ä", "í", "ó",
               "th", "qu", "sch", "ei", "ou", "the", "ing", "ent")

ASCII_LETTERS = "".join(chr(c) for c in range(ord("A"), ord("Z") + 1)) + \
    "".join(chr(c) for c in range(ord("a"), ord("z") + 1))
CHAR_CLASSES = {
    "ascii_letters": ASCII_LETTERS,
    "digits": "0123456789",
    "spaces": " ",
    "newlines": "\n",
    "punctuation": ".,;:!?",
}


def feature_names() -> list[str]:
    return (["log_chars"] + [f"share_{k}" for k in CHAR_CLASSES]
            + ["share_non_ascii"] + [f"rate_{i}" for i in range(len(CHAR_PROBES))])


# Bytes below 128 are ASCII characters; of any other character's bytes, the
# continuations (10xxxxxx) are all but the first.
ASCII_BYTES = bytes(range(128))
CONTINUATIONS = bytes(range(128, 192))


def char_counts(text: bytes) -> list[int]:
    """Of a UTF-8 text: the characters of each of ``CHAR_CLASSES``, those beyond
    ASCII, and the occurrences of each of ``CHAR_PROBES`` (leftmost, disjoint)."""
    counts = []
    rest = text
    for chars in CHAR_CLASSES.values():    # disjoint, the letters first
        left = rest.translate(None, chars.encode())
        counts.append(len(rest) - len(left))
        rest = left
    wide = rest.translate(None, ASCII_BYTES)
    counts.append(len(wide.translate(None, CONTINUATIONS)))
    return counts + [(text if probe.isascii() else wide).count(probe.encode()) for probe in CHAR_PROBES]


def char_statistics(df: DataFrame, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """``keep...`` plus one double column per name in ``feature_names()``; null
    for a null text."""
    rows = df.select(*keep, F.length(text_col).alias("__chars"), F.col(text_col).cast("binary").alias("__text"))
    hits = [f"__hits_{i}" for i in range(len(CHAR_CLASSES) + 1 + len(CHAR_PROBES))]
    schema = StructType(rows.schema.fields[:-1] + [StructField(c, IntegerType()) for c in hits])

    def run(batches):
        for batch in batches:
            counts = [char_counts(t.as_py()) if t.is_valid else [None] * len(hits)
                      for t in batch.column(batch.num_columns - 1)]
            columns = zip(*counts) if counts else [()] * len(hits)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(c, pa.int32()) for c in columns]], schema.names)

    n = F.greatest(F.col("__chars"), F.lit(1)).cast("double")
    cols = [F.log1p(F.col("__chars").cast("double"))]
    cols += [F.col(c) / n for c in hits[:len(CHAR_CLASSES) + 1]]
    cols += [F.col(c) / n * 1000.0 for c in hits[len(CHAR_CLASSES) + 1:]]
    return rows.mapInArrow(run, schema).select(
        *keep, *[c.alias(name) for c, name in zip(cols, feature_names(), strict=True)])
