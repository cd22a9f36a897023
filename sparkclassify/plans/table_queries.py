"""Queries for sources, projections, cleaning, splits and label indexing."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..operators.cleaning import (cast_numeric, drop_missing, drop_nulls,
                                  score_label_pairs, with_label)
from ..operators.sampling import union_all, with_split_part
from ..operators.vectors import assemble, index_labels
from ..session import load_table, shared_path
from ..sources.delimited import read_delimited, write_delimited
from ..sources.lines import explode_lines
from ..sources.reports import describe_schema, preview, rename_columns, split_counts
from . import sqlparts as S
from .catalog import register
from .common import SPLIT_SEED

PART_SCHEMA = ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, "
               "p_size INT, p_retailprice DOUBLE")


@register("csv_source", "SELECT * FROM part")
def csv_source(spark, sf_dir):
    """The whole ``part`` table written as CSV with a quoted header to the
    shared folder, read back with an explicit schema in FAILFAST mode."""
    path = shared_path(spark, "csv")
    write_delimited(load_table(spark, sf_dir, "part"), path, header=True, quote_all=True)
    return read_delimited(spark, path, PART_SCHEMA, header=True, strict=True)


@register("rename_columns", """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation,
  c_acctbal AS balance, c_mktsegment AS segment FROM customer""")
def rename_columns_query(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return rename_columns(cust, "id", "name", "nation", "balance", "segment")


@register("preview_top_n", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def preview_top_n(spark, sf_dir):
    """``show(20)`` made deterministic: the 20 most expensive orders."""
    orders = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    return preview(orders, 20, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@register("split_counts", f"""SELECT part, count(*) AS n_rows FROM (
  SELECT {S.split_part(['o_orderkey'], [0.85, 0.15], SPLIT_SEED)} AS part FROM orders)
GROUP BY part""")
def split_counts_query(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey")
    return split_counts(with_split_part(orders, ["o_orderkey"], [0.85, 0.15], SPLIT_SEED))


_ORDERS_COLUMNS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                   ("o_orderstatus", "string"), ("o_totalprice", "double"),
                   ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@register("schema_report", "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{n}' AS name, '{t}' AS data_type, true AS nullable, "
    f"count(*) AS n_rows, count(*) - count({n}) AS n_nulls FROM orders"
    for i, (n, t) in enumerate(_ORDERS_COLUMNS)))
def schema_report(spark, sf_dir):
    """``printSchema`` as rows, with measured row and null counts."""
    return describe_schema(load_table(spark, sf_dir, "orders"))


def _tax_strings(spark, sf_dir):
    """Tax as text, ``?`` where no tax was recorded (the cytology table's
    missing-marker shape)."""
    li = load_table(spark, sf_dir, "lineitem")
    tax = (F.when(F.col("l_tax") == 0, F.lit("?"))
            .otherwise(F.col("l_tax").cast("string")))
    return li.select("l_orderkey", "l_linenumber", tax.alias("tax"))


_TAX_SQL = """WITH t AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_tax = 0 THEN '?' ELSE CAST(l_tax AS VARCHAR) END AS tax FROM lineitem)"""


@register("missing_marker_filter", _TAX_SQL + "\nSELECT * FROM t WHERE tax <> '?'")
def missing_marker_filter(spark, sf_dir):
    return drop_missing(_tax_strings(spark, sf_dir), ["tax"], "?")


@register("strict_numeric_cast", _TAX_SQL + """
SELECT l_orderkey, l_linenumber, CAST(tax AS DOUBLE) AS tax FROM t WHERE tax <> '?'""")
def strict_numeric_cast(spark, sf_dir):
    kept = drop_missing(_tax_strings(spark, sf_dir), ["tax"], "?")
    return cast_numeric(kept, ["tax"], strict=True)


@register("null_row_drop", """SELECT conv_id, turn, nullif(role, 'system') AS role, text
FROM conversations WHERE nullif(role, 'system') IS NOT NULL""")
def null_row_drop(spark, sf_dir):
    """System turns have no speaker role (made null); those rows go, text
    that is empty would stay."""
    conv = load_table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.expr("nullif(role, 'system')").alias("role"), "text")
    return drop_nulls(conv, ["role"])


@register("project_reorder", """SELECT l_linestatus, l_returnflag, l_quantity, l_orderkey,
  l_linenumber FROM lineitem""")
def project_reorder(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    return li.select("l_linestatus", "l_returnflag", "l_quantity", "l_orderkey", "l_linenumber")


@register("drop_columns", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice
FROM orders""")
def drop_columns(spark, sf_dir):
    return load_table(spark, sf_dir, "orders").drop("o_orderdate", "o_orderpriority")


@register("constant_label", f"""SELECT item_id, CAST(1.0 AS DOUBLE) AS label,
  {S.clean('text')} AS clean FROM benchmark""")
def constant_label(spark, sf_dir):
    bench = load_table(spark, sf_dir, "benchmark").select(
        "item_id", clean_text("text").alias("clean"))
    return with_label(bench, 1.0)


@register("score_label_pairs", """SELECT CASE WHEN d.lang = 'en' THEN CAST(0.0 AS DOUBLE)
  ELSE CAST(1.0 AS DOUBLE) END AS prediction, CAST(l.quality AS DOUBLE) AS label
FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE l.quality IS NOT NULL""")
def score_label_pairs_query(spark, sf_dir):
    """Rule prediction per document, label where one exists; documents
    without a label give a null and are skipped."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = load_table(spark, sf_dir, "labels").select("doc_id", "quality")
    joined = docs.join(labels, "doc_id", "left").select(
        F.when(F.col("lang") == "en", 0.0).otherwise(1.0).alias("prediction"),
        F.col("quality").alias("label"))
    return score_label_pairs(joined)


@register("union_labeled", f"""WITH {S.DOC_LINES}
SELECT CAST(0.0 AS DOUBLE) AS label, {S.clean('line')} AS clean FROM doc_lines
UNION ALL
SELECT CAST(1.0 AS DOUBLE) AS label, u.line AS clean FROM benchmark,
  unnest(string_split({S.clean('text')}, chr(10))) AS u(line)""")
def union_labeled(spark, sf_dir):
    """Two labelled line sources in one bag: document lines as 0.0 and
    benchmark passages as 1.0, duplicates kept."""
    docs = explode_lines(load_table(spark, sf_dir, "documents"), "text", "line", None)
    bench = explode_lines(
        load_table(spark, sf_dir, "benchmark").select(clean_text("text").alias("text")),
        "text", "clean", None)
    a = with_label(docs.select(clean_text("line").alias("clean")), 0.0)
    b = with_label(bench, 1.0)
    return union_all(a.select("label", "clean"), b.select("label", "clean"))


@register("hash_split_8515", f"""SELECT o_orderkey,
  {S.split_part(['o_orderkey'], [0.85, 0.15], SPLIT_SEED)} AS part FROM orders""")
def hash_split_8515(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey")
    return with_split_part(orders, ["o_orderkey"], [0.85, 0.15], SPLIT_SEED)


@register("hash_split_7525", f"""SELECT l_orderkey, l_linenumber,
  {S.split_part(['l_orderkey', 'l_linenumber'], [0.75, 0.25], SPLIT_SEED)} AS part
FROM lineitem""")
def hash_split_7525(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return with_split_part(li, ["l_orderkey", "l_linenumber"], [0.75, 0.25], SPLIT_SEED)


@register("hash_split_8020", f"""SELECT doc_id,
  {S.split_part(['doc_id'], [0.8, 0.2], SPLIT_SEED)} AS part FROM documents""")
def hash_split_8020(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id")
    return with_split_part(docs, ["doc_id"], [0.8, 0.2], SPLIT_SEED)


@register("assemble_vector", """SELECT l_orderkey, l_linenumber, l_quantity AS f0,
  l_extendedprice AS f1, l_discount AS f2, l_tax AS f3 FROM lineitem""")
def assemble_vector(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *cols)
    assembled = assemble(li, cols, "features")
    arr = vector_to_array(assembled["features"])
    return assembled.select("l_orderkey", "l_linenumber",
                     *[arr[i].alias(f"f{i}") for i in range(len(cols))])


@register("label_index", """WITH idx AS (
  SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) AS type_index
  FROM part GROUP BY p_type)
SELECT p_partkey, p_type, type_index FROM part JOIN idx USING (p_type)""")
def label_index(spark, sf_dir):
    part = load_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    indexed, _ = index_labels(part, "p_type", "type_index")
    return indexed


@register("page_lines", """SELECT p.page_id, CAST(u.n - 1 AS INTEGER) AS line_no,
  CAST(length(u.line) AS INTEGER) AS line_chars, u.line
FROM pages p, unnest(string_split(p.html, chr(10))) WITH ORDINALITY AS u(line, n)""")
def page_lines(spark, sf_dir):
    """Raw web pages as a keyed line source."""
    pages = load_table(spark, sf_dir, "pages").select("page_id", "html")
    lines = explode_lines(pages, "html", "line", "line_no", keep=("page_id",))
    return lines.select("page_id", "line_no", F.length("line").alias("line_chars"), "line")


@register("event_type_index", """WITH idx AS (
  SELECT event_type, CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE)
    AS type_index
  FROM events GROUP BY event_type)
SELECT event_id, event_type, type_index FROM events JOIN idx USING (event_type)""")
def event_type_index(spark, sf_dir):
    """Label index over the event stream's types (most frequent -> 0.0)."""
    events = load_table(spark, sf_dir, "events").select("event_id", "event_type")
    indexed, _ = index_labels(events, "event_type", "type_index")
    return indexed


@register("embedding_vectors", """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n_dims,
  sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS l2_norm,
  CAST(label AS DOUBLE) AS label
FROM embeddings""", round6=("l2_norm",))
def embedding_vectors(spark, sf_dir):
    """Stored ``array<float>`` embeddings as ML vectors (``array_to_vector``)
    with their width and L2 norm, read back with ``vector_to_array``."""
    from pyspark.ml.functions import array_to_vector
    emb = load_table(spark, sf_dir, "embeddings")
    vec = emb.select("vec_id", array_to_vector("embedding").alias("features"),
                     F.col("label").cast("double").alias("label"))
    arr = vector_to_array(F.col("features"))
    sq = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x * x)
    return vec.select("vec_id", F.size(arr).alias("n_dims"), F.sqrt(sq).alias("l2_norm"), "label")


@register("loader_chain", """WITH t AS (
  SELECT p_partkey, p_brand, p_size, p_retailprice FROM part WHERE p_size % 7 <> 0),
idx AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS DOUBLE) AS label
  FROM t GROUP BY p_brand)
SELECT p_partkey, CAST(p_size AS DOUBLE) AS f0, p_retailprice AS f1, label FROM t JOIN idx USING (p_brand)""")
def loader_chain(spark, sf_dir):
    """The tabular loader as one chain over the whole ``part`` table: written
    as quoted CSV with ``?`` for some sizes -> read as text -> rows with the
    marker dropped -> strict cast -> vector -> label index."""
    size = F.when(F.col("p_size") % 7 == 0, "?").otherwise(F.col("p_size").cast("string"))
    part = load_table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", size.alias("p_size"), F.col("p_retailprice").cast("string").alias("p_retailprice"))
    path = shared_path(spark, "loader")
    write_delimited(part, path, header=True, quote_all=True)
    rows = read_delimited(spark, path, "p_partkey BIGINT, p_brand STRING, p_size STRING, p_retailprice STRING")
    numeric = cast_numeric(drop_missing(rows, ["p_size"], "?"), ["p_size", "p_retailprice"], strict=True)
    indexed, _ = index_labels(assemble(numeric, ["p_size", "p_retailprice"], "features"), "p_brand", "label")
    x = vector_to_array("features")
    return indexed.select("p_partkey", x[0].alias("f0"), x[1].alias("f1"), "label")
