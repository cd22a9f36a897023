"""Quality rules by repetition coverage.

Per document: word and symbol counts, repeated lines, and the share of its
characters that lies inside word n-grams of several lengths, or lines, that
already occurred earlier in the same document.  Everything is row-local: one
pass over the text in Arrow batches, no exchange, so a hot source or a large
group of copies needs no special care and a lost task is simply run again.

n-grams are compared by 64-bit rolling hashes.  A window of more than three
words can only be a repeat where the three-word windows at both its ends are,
so longer lengths look at those positions alone.

Defined results: a null or empty text has no word and fails the base rule
(``n_words`` under the minimum).  Other columns, nulls in them, repeated rows
and equal ``doc_id`` play no part; every input row gives one output row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy
from .textblocks import _U, blocks, mix, text_array, window_factors, word_bounds, word_hashes

# The symbols counted by the base rule.
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class QualityRules:
    """Limits in percent.  ``later_ngram_percent``: n-gram length -> largest
    share of a text's word characters inside n-grams seen before in it."""
    min_words: int = 50
    repeat_window: int = 3
    max_repeat_percent: int = 50
    later_line_percent: int = 20
    later_ngram_percent: tuple = ((5, 15), (6, 14), (7, 13), (8, 12), (9, 11), (10, 10))


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_CHAR_START = (np.arange(256) & 0xC0) != 0x80
_FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
           ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
           ("base_failed", pa.bool_()), ("kept", pa.bool_())]


def _prefix(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(flags.size + 1, np.int32 if flags.size < 1 << 31 else np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _repeats(keys: np.ndarray):
    """Masks over ``keys``: occurs twice or more; occurred before."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(keys.size, bool)
    again[1:] = same
    any_ = again.copy()
    any_[:-1] |= same
    repeated, later = np.zeros(keys.size, bool), np.zeros(keys.size, bool)
    repeated[order], later[order] = any_, again
    return repeated, later


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Mask of the positions inside ``[start, start + n)``."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _window_keys(words: np.ndarray, at: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    total = mix(doc[at].astype(_U) + _U(n << 40))
    for j, factor in enumerate(window_factors(n)):
        total = total + words[at + j] * factor
    return mix(total)


def _block_profile(data: np.ndarray, offsets: np.ndarray, rules: QualityRules) -> list[np.ndarray]:
    docs = offsets.size - 1
    starts, ends, doc = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    chars_before = _prefix(_CHAR_START[data])
    chars = chars_before[ends] - chars_before[starts]
    per_doc = lambda values: np.bincount(doc, values, docs).astype(np.int64)
    n_words, word_chars = np.bincount(doc, minlength=docs), per_doc(chars)
    symbols = _prefix(_SYMBOL[data])
    n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]

    # lines that hold a word, in text order
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < data.size]
    line_doc = np.searchsorted(offsets, line_starts, "right") - 1
    next_break = np.append(breaks, data.size)[np.searchsorted(breaks, line_starts)]
    line_ends = np.minimum(next_break, offsets[line_doc + 1])
    first_word = np.searchsorted(starts, line_starts)
    last_word = np.searchsorted(starts, line_ends)
    full = last_word > first_word
    line_starts, line_ends, line_doc = line_starts[full], line_ends[full], line_doc[full]
    first_word, last_word = first_word[full], last_word[full]
    line_keys = mix(word_hashes(data, line_starts, line_ends) + mix(line_doc.astype(_U)))
    _, later_line = _repeats(line_keys)
    n_dup_lines = np.bincount(line_doc[later_line], minlength=docs)
    word_chars_before = np.concatenate([[0], np.cumsum(chars)])
    line_chars = word_chars_before[last_word] - word_chars_before[first_word]
    dup_line_chars = np.bincount(line_doc[later_line], line_chars[later_line], docs)

    n = rules.repeat_window
    at = np.flatnonzero(doc[n - 1:] == doc[:max(0, doc.size - n + 1)]) if doc.size >= n else doc[:0]
    repeated, _ = _repeats(_window_keys(words, at, doc, n))
    seeds = np.zeros(doc.size + 1, bool)
    seeds[at[repeated]] = True
    n_repeat_words = per_doc(_covered(at[repeated], n, doc.size))

    base_failed = (n_words < rules.min_words) | (100 * n_repeat_words > rules.max_repeat_percent * n_words)
    kept = ~base_failed & (100 * dup_line_chars <= rules.later_line_percent * word_chars)
    candidates = np.flatnonzero(seeds)
    for n, percent in rules.later_ngram_percent:
        inside = candidates[candidates + n <= doc.size]
        inside = inside[(doc[inside + n - 1] == doc[inside]) & seeds[inside + n - rules.repeat_window]]
        _, later = _repeats(_window_keys(words, inside, doc, n))
        covered = _covered(inside[later], n, doc.size)
        kept &= 100 * per_doc(np.where(covered, chars, 0)) <= percent * word_chars
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept]


def _profile_columns(texts: pa.Array, rules: QualityRules) -> list[pa.Array]:
    parts = [_block_profile(data, offsets, rules) for _, _, data, offsets in blocks(texts)]
    return [pa.array(np.concatenate([p[k] for p in parts]) if parts else [], kind)
            for k, (_, kind) in enumerate(_FIELDS)]


def quality_profile(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    rules: QualityRules = QualityRules()) -> DataFrame:
    """``id_col``, the counts, ``base_failed`` and ``kept`` of every row."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *_profile_columns(text_array(batch, "text"), rules)],
                ["id", *(name for name, _ in _FIELDS)])

    kinds = {pa.int64(): "long", pa.bool_(): "boolean"}
    schema = f"id {narrow.schema['id'].dataType.simpleString()}, " + ", ".join(
        f"{name} {kinds[kind]}" for name, kind in _FIELDS)
    return narrow.mapInArrow(tidy(run), schema).withColumnRenamed("id", id_col)


def quality_filter(docs: DataFrame, text_col: str = "text",
                   rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows whose text the rules keep, all columns unchanged."""
    place = docs.columns.index(text_col)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):      # small batches back to the JVM
                batch = whole.slice(at, 1024)
                texts = text_array(pa.RecordBatch.from_arrays([batch.column(place)], ["text"]), "text")
                yield batch.filter(_profile_columns(texts, rules)[-1])

    return docs.mapInArrow(tidy(run), docs.schema)


def op9_quality(spark, sf_dir):
    """Counts and verdict for every row of ``documents``."""
    return quality_profile(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_RULES = QualityRules()
OP9_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS i FROM d),
line_rank AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS k
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
line_stat AS (
  SELECT doc_id, count(*) AS n_dup_lines,
    sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) AS dup_line_chars
  FROM line_rank WHERE k > 1 GROUP BY doc_id),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d),
three AS (
  SELECT words.doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g
  FROM words JOIN d USING (doc_id) WHERE i + 2 <= len(ws)),
repeated AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM three) WHERE c > 1),
grams AS (
  SELECT r.doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM repeated r JOIN d USING (doc_id), (SELECT unnest([{', '.join(str(n) for n, _ in _RULES.later_ngram_percent)}]) AS n)
  WHERE i + n - 1 <= len(ws)),
later AS (
  SELECT doc_id, n, i FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, n, g ORDER BY i) AS k FROM grams) WHERE k > 1),
covered AS (
  SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS i FROM later
  UNION SELECT doc_id, 3 AS n, unnest(range(i, i + 3)) AS i FROM repeated),
word_stat AS (
  SELECT doc_id, count(*) FILTER (n = 3) AS n_repeat_words,
    {', '.join(f"sum(length(w)) FILTER (n = {n}) AS later{n}" for n, _ in _RULES.later_ngram_percent)}
  FROM covered JOIN words USING (doc_id, i) GROUP BY doc_id),
base AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(dup_line_chars, 0) AS dup_line_chars,
    {', '.join(f"coalesce(later{n}, 0) AS later{n}" for n, _ in _RULES.later_ngram_percent)}
  FROM d LEFT JOIN line_stat USING (doc_id) LEFT JOIN word_stat USING (doc_id)),
verdict AS (
  SELECT *, n_words < {_RULES.min_words}
    OR 100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * dup_line_chars <= {_RULES.later_line_percent} * word_chars
  AND {' AND '.join(f"100 * later{n} <= {p} * word_chars" for n, p in _RULES.later_ngram_percent)} AS kept
FROM verdict"""
