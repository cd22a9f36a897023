"""Sources, cleaning and splits."""

import pytest
from pyspark.sql import functions as F

from sparkclassify.operators.cleaning import cast_numeric, drop_missing, drop_nulls, with_label
from sparkclassify.operators.sampling import hash_split, union_all, with_split_part
from sparkclassify.operators.vectors import assemble, index_labels
from sparkclassify.session import load_table
from sparkclassify.sources.delimited import read_delimited, select_positions, write_delimited
from sparkclassify.sources.lines import explode_lines, read_lines
from sparkclassify.sources.reports import describe_schema, preview

from .conftest import SF_SMALL
from .fixtures import cytology_csv, flowers

CYTO_SCHEMA = ("id int, c1 string, c2 string, c3 string, c4 string, c5 string, c6 string, "
               "c7 string, c8 string, c9 string, class string")


def test_quoted_header_and_missing_marker(spark, tmp_path):
    path = str(tmp_path / "cyto.csv")
    lines = cytology_csv(path)
    df = read_delimited(spark, path, CYTO_SCHEMA)
    assert df.count() == len(lines) - 1
    kept = drop_missing(df, ["c6"], "?")
    n_marked = sum(1 for ln in lines[1:] if ln.split(",")[6] == "?")
    assert kept.count() == len(lines) - 1 - n_marked
    feats = cast_numeric(kept, [f"c{i}" for i in range(1, 10)], strict=True)
    assert dict(feats.dtypes)["c6"] == "double"
    # Repeated ids are kept: they are not a key.
    assert kept.select("id").distinct().count() < kept.count()


def test_strict_cast_fails_on_marker(spark, tmp_path):
    path = str(tmp_path / "cyto.csv")
    cytology_csv(path)
    df = read_delimited(spark, path, CYTO_SCHEMA)
    with pytest.raises(Exception):
        cast_numeric(df, ["c6"], strict=True).collect()
    loose = cast_numeric(df, ["c6"], strict=False)
    assert loose.where(F.col("c6").isNull()).count() > 0


def test_failfast_on_bad_number(spark, tmp_path):
    path = str(tmp_path / "bad.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,2.5\n2,oops\n")
    with pytest.raises(Exception):
        read_delimited(spark, path, "a int, b double").collect()


def test_flowers_positions_assemble_index(spark):
    df = select_positions(flowers(spark), [1, 2, 3, 4, 5], ["f1", "f2", "f3", "f4", "species"])
    out = assemble(df, ["f1", "f2", "f3", "f4"], "features")
    assert out.first().features.size == 4
    indexed, model = index_labels(out, "species", "label")
    # 50 of each: ties in frequency go alphabetically.
    assert list(model.labels) == ["Iris-setosa", "Iris-versicolor", "Iris-virginica"]


def test_unseen_label_is_an_error(spark):
    train = spark.createDataFrame([("a",), ("b",)], "y string")
    test = spark.createDataFrame([("c",)], "y string")
    _, model = index_labels(train, "y", "label")
    with pytest.raises(Exception):
        model.transform(test).collect()


def test_line_reader_and_explode(spark, tmp_path):
    p = tmp_path / "lines"
    p.mkdir()
    (p / "a.txt").write_text("first line\n\nthird  line\n")
    df = read_lines(spark, str(p))
    assert [r.text for r in df.collect()] == ["first line", "", "third  line"]
    docs = spark.createDataFrame([(7, "x\ny\n")], "doc_id long, text string")
    got = [(r.line_no, r.line) for r in explode_lines(docs, keep=("doc_id",)).collect()]
    assert got == [(0, "x"), (1, "y"), (2, "")]


def test_drop_nulls_keeps_empty_strings(spark):
    df = spark.createDataFrame([("",), (None,), ("a",)], "t string")
    assert sorted(r.t for r in drop_nulls(df, ["t"]).collect()) == ["", "a"]


def test_union_keeps_duplicates(spark):
    a = with_label(spark.createDataFrame([("x",), ("x",)], "t string"), 0.0)
    b = with_label(spark.createDataFrame([("x",)], "t string"), 1.0)
    assert union_all(a, b).count() == 3


@pytest.mark.parametrize("weights", [[0.85, 0.15], [0.75, 0.25], [0.8, 0.2], [1, 1, 2]])
def test_hash_split_disjoint_complete_deterministic(spark, weights):
    df = load_table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber")
    keys = ["l_orderkey", "l_linenumber"]
    parts = hash_split(df, keys, weights, 98765)
    counts = [p.count() for p in parts]
    assert sum(counts) == df.count()
    assert parts[0].intersect(parts[1]).count() == 0
    share = counts[0] / sum(counts)
    assert abs(share - weights[0] / sum(weights)) < 0.03
    again = with_split_part(df.repartition(5), keys, weights, 98765)
    first = with_split_part(df, keys, weights, 98765)
    assert again.exceptAll(first).count() == 0
    other_seed = with_split_part(df, keys, weights, 1)
    assert other_seed.exceptAll(first).count() > 0


def test_preview_is_deterministic(spark):
    df = load_table(spark, SF_SMALL, "orders")
    a = [r.o_orderkey for r in preview(df, 5, [F.desc("o_totalprice"), "o_orderkey"]).collect()]
    b = [r.o_orderkey for r in preview(df.repartition(3), 5, [F.desc("o_totalprice"), "o_orderkey"]).collect()]
    assert a == b and len(a) == 5


def test_describe_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    rows = {r.name: r for r in describe_schema(df).collect()}
    assert rows["a"].data_type == "int" and rows["a"].n_nulls == 0
    assert rows["b"].n_nulls == 1 and rows["b"].n_rows == 2 and rows["b"].position == 1


def test_delimited_round_trip_of_empty_null_and_newline(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "two\nlines"), (4, 'a "quoted", value')], "id int, v string")
    path = str(tmp_path / "csv")
    write_delimited(df, path, quote_all=True, null_value="\\N", empty_value="<empty>")
    got = read_delimited(spark, path, "id int, v string", null_value="\\N", empty_value="<empty>", multi_line=True)
    assert sorted(tuple(r) for r in got.replace("<empty>", "", ["v"]).collect()) == sorted(tuple(r) for r in df.collect())


def test_null_text_keeps_a_row(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, None), (3, "")], "id int, text string")
    got = sorted((r.id, r.line_no, r.line) for r in explode_lines(df, keep=("id",)).collect() if r.line is not None)
    assert got == [(1, 0, "a"), (1, 1, "b"), (3, 0, "")]
    assert [tuple(r) for r in explode_lines(df, keep=("id",)).filter("line IS NULL").collect()] == [(2, None, None)]
