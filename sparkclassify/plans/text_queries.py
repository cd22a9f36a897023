"""Queries for the text scalar/array operators (T1-T7) and line sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_text, java_trim, strip_punctuation
from ..operators.text import remove_stop_words, term_counts, tokenize
from ..session import load_table, shared_path
from ..sources.lines import read_lines, write_lines
from . import sqlparts as S
from .catalog import register
from .common import clean_lines, document_lines, line_terms


@register("line_source", f"""WITH {S.DOC_LINES}
SELECT doc_id, line_no, label, line, CAST(length(line) AS INTEGER) AS line_chars FROM doc_lines""")
def line_source(spark, sf_dir):
    """Stored documents split into lines, keyed by (doc_id, line_no)."""
    return document_lines(spark, sf_dir).withColumn("line_chars", F.length("line"))


@register("text_file_source", f"""WITH {S.DOC_LINES}
SELECT line AS text, count(*) AS n_lines FROM doc_lines GROUP BY line""")
def text_file_source(spark, sf_dir):
    """All document texts written as text files to the shared folder, read
    back with the line reader; the multiset of lines must survive."""
    path = shared_path(spark, "lines")
    write_lines(load_table(spark, sf_dir, "documents"), path, "text")
    return (read_lines(spark, path, "text")
            .groupBy("text").agg(F.count(F.lit(1)).alias("n_lines")))


@register("text_clean_alnum", f"""SELECT doc_id, {S.strip('text')} AS stripped,
  {S.clean('text')} AS clean FROM documents""")
def text_clean_alnum(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    return docs.select("doc_id", strip_punctuation("text").alias("stripped"),
                       clean_text("text").alias("clean"))


@register("text_clean_alpha", f"""SELECT doc_id, {S.clean('text', keep_digits=False)} AS clean
FROM documents""")
def text_clean_alpha(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    return docs.select("doc_id", clean_text("text", keep_digits=False).alias("clean"))


@register("text_trim", f"""WITH {S.DOC_LINES}
SELECT doc_id, line_no, {S.java_trim('line')} AS trimmed FROM doc_lines""")
def text_trim(spark, sf_dir):
    lines = document_lines(spark, sf_dir)
    return lines.select("doc_id", "line_no", java_trim("line").alias("trimmed"))


@register("text_lower", """SELECT conv_id, turn, lower(text) AS lowered FROM conversations""")
def text_lower(spark, sf_dir):
    conv = load_table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", F.lower("text").alias("lowered"))


@register("tokenize", f"""WITH {S.CLEAN_LINES}, t AS (
  SELECT doc_id, line_no, {S.tokens('clean')} AS words FROM clean_lines)
SELECT doc_id, line_no, CAST(len(words) AS INTEGER) AS n_words,
  array_to_string(words, '|') AS words_joined FROM t""")
def tokenize_query(spark, sf_dir):
    toks = tokenize(clean_lines(spark, sf_dir), "clean", "words")
    return toks.select("doc_id", "line_no", F.size("words").alias("n_words"),
                       F.array_join("words", "|").alias("words_joined"))


@register("stop_word_removal", f"""WITH {S.CLEAN_LINES}, t AS (
  SELECT doc_id, line_no, {S.tokens('clean')} AS words FROM clean_lines), r AS (
  SELECT doc_id, line_no, {S.no_stop_words('words')} AS terms FROM t)
SELECT doc_id, line_no, CAST(len(terms) AS INTEGER) AS n_terms,
  array_to_string(terms, '|') AS terms_joined FROM r""")
def stop_word_removal(spark, sf_dir):
    toks = tokenize(clean_lines(spark, sf_dir), "clean", "words")
    out = remove_stop_words(toks, "words", "terms")
    return out.select("doc_id", "line_no", F.size("terms").alias("n_terms"),
                      F.array_join("terms", "|").alias("terms_joined"))


@register("explode_terms", f"""WITH {S.LINE_TERMS}
SELECT label, term, count(*) AS n_occurrences
FROM (SELECT label, unnest(terms) AS term FROM line_terms)
GROUP BY label, term""")
def explode_terms_query(spark, sf_dir):
    """Terms per label over all document lines (the minimum slice:
    line source -> clean -> tokenise -> stop words -> explode)."""
    return term_counts(line_terms(spark, sf_dir), "terms", by=("label",))
