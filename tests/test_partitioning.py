"""Partitioning helpers and what fits rely on: one layout, nothing left behind."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from sparkclassify.operators.models import random_forest
from sparkclassify.operators.partitioning import by_key, fit_table, kept, spread
from sparkclassify.operators.vectors import assembler
from sparkclassify.session import materialize, release_tables

from .conftest import SF_SMALL


def test_spread_only_touches_narrow_inputs(spark):
    slots = spark.sparkContext.defaultParallelism
    narrow = spark.range(100).coalesce(1)
    wide = spark.range(0, 1000, 1, numPartitions=slots * 2)
    assert spread(narrow, "id").rdd.getNumPartitions() == slots
    # A wide input is returned as it is: no exchange is added.
    assert spread(wide, "id") is wide


def test_by_key_clusters_equal_keys(spark):
    df = spark.range(2000).selectExpr("id % 37 AS k", "id")
    parts = (by_key(df, "k", 8).rdd
             .mapPartitions(lambda rows: [sorted({r.k for r in rows})]).collect())
    seen = [k for p in parts for k in p]
    assert len(seen) == len(set(seen)) == 37  # each key in exactly one partition


def test_forest_does_not_depend_on_layout(spark):
    rows = spark.range(600).selectExpr("id AS doc_id", "CAST(id % 7 AS DOUBLE) AS a", "sin(id) AS b",
                                       "CAST((id * 31 % 11) > 5 AS DOUBLE) AS label")
    found = []
    for data in (rows.coalesce(1), rows.repartition(13), rows.orderBy(F.desc("doc_id"))):
        table = assembler(["a", "b"]).transform(fit_table(data, "doc_id"))
        with kept(table) as train:
            found.append(random_forest(num_trees=5, max_depth=4).fit(train).featureImportances.toArray().tolist())
    assert found[0] == found[1] == found[2]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_default_seed_is_the_same_in_every_process():
    code = ("from sparkclassify.operators.models import FOREST_SEED; import inspect; "
            "from sparkclassify.operators import models; "
            "print(inspect.signature(models.random_forest).parameters['seed'].default)")
    seen = {subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                           env=os.environ | {"PYTHONHASHSEED": h}).stdout for h in ("1", "2")}
    assert seen == {"98765\n"}


def test_written_tables_are_released(spark):
    table = materialize(spark.range(10), "release")
    path = table.inputFiles()[0].removeprefix("file://").removeprefix("file:").rpartition("/")[0]
    assert os.path.isdir(path)
    assert release_tables(spark) >= 1
    assert not os.path.exists(path) and release_tables(spark) == 0


def test_session_without_configuration(tmp_path):
    """With an empty Spark configuration the session starts; the first use of
    the shared folder says which key is missing, and a folder set on the
    builder is used."""
    (tmp_path / "conf").mkdir()
    code = f"""
from sparkclassify.session import get_spark, materialize
quiet = {{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}}
spark = get_spark(master="local[1]", extra_conf=quiet)
try:
    materialize(spark.range(3), "x")
except RuntimeError as e:
    assert "spark.checkpoint.dir" in str(e)
else:
    raise SystemExit("no error")
spark.stop()
spark = get_spark(master="local[1]", extra_conf={{**quiet, "spark.checkpoint.dir": {str(tmp_path / 'shared')!r}}})
assert materialize(spark.range(3), "x").count() == 3
spark.stop()
"""
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180,
                         env=os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf")})
    assert run.returncode == 0, run.stderr[-2000:]
    assert os.listdir(tmp_path / "shared")


def test_wide_input_gives_the_same_rows_without_a_text_exchange(spark, tmp_path):
    """A 16-file copy of ``documents`` takes the plan of a large table."""
    from sparkclassify.plans.common import line_terms
    from sparkclassify.plans.jobs import job_text_naive_bayes
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.repartition(16, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    plan = line_terms(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    key = lambda df: sorted((r.doc_id, r.line_no, r.prediction, round(r.score, 6)) for r in df.collect())
    assert key(job_text_naive_bayes(spark, str(tmp_path))) == key(job_text_naive_bayes(spark, SF_SMALL))
