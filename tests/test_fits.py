"""Fits by value: the second-order logistic fit, forests as tables, shared
search, layouts that follow from the rows."""

import math
import random
import threading
import time

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkclassify.operators.forest_depths import predictions_by_depth
from sparkclassify.operators.forest_table import ForestArrays, forest_nodes, route
from sparkclassify.operators.models import LINEAGE_LEVELS, logistic_regression, random_forest, with_short_lineage
from sparkclassify.operators.newton import newton_logistic
from sparkclassify.operators.partitioning import FitLayout, fit_table, kept, layout_of
from sparkclassify.operators.tuning import fits_at_once, holdout_search, run_all, trees_at_once, weighted_f1
from sparkclassify.operators.vectors import assembler
from sparkclassify.plans.jobs import fingerprint, forest_search
from sparkclassify.session import load_table

from .conftest import SF_SMALL

NAMES = ["a", "b", "c", "d"]


def points(spark, n=900, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.gauss(0, 1), rng.gauss(5, 100), rng.random() * 1e-3, float(rng.random() < .1)]
        z = .5 + 1.3 * x[0] - .02 * x[1] + 900 * x[2] + x[3]
        rows.append((i, *x, float(rng.random() < 1 / (1 + math.exp(-z)))))
    return spark.createDataFrame(rows, "doc_id long, a double, b double, c double, d double, label double")


def test_newton_reaches_the_optimum(spark):
    df = points(spark).cache()
    fit = newton_logistic(df, NAMES)
    assert fit.gradient < 1e-10 and fit.steps < 12 and fit.rows == 900
    first = logistic_regression(max_iter=500).setTol(1e-14).fit(assembler(NAMES).transform(df))
    assert list(fit.coefficients) == pytest.approx(list(first.coefficients), rel=1e-4)
    assert fit.intercept == pytest.approx(first.intercept, rel=1e-4)
    x = np.array(df.select(*NAMES, "label").collect())
    raw = x[:, :4] @ fit.coefficients + fit.intercept
    assert fit.loss == pytest.approx(float(np.mean(np.logaddexp(0, -raw * (2 * x[:, 4] - 1)))))
    assert [r.p for r in fit.transform(df).collect()] == pytest.approx(list(1 / (1 + np.exp(-raw))))
    # the same from another layout, to rounding
    again = newton_logistic(df.repartition(11), NAMES)
    assert list(again.coefficients) == pytest.approx(list(fit.coefficients), rel=1e-9)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 1
    df.unpersist()


def test_newton_on_awkward_tables(spark):
    df = points(spark).withColumn("same", F.lit(3.0))
    fit = newton_logistic(df, [*NAMES, "same"])
    assert fit.coefficients[4] == 0 and fit.gradient < 1e-6
    separable = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id > 60 AS DOUBLE) AS label")
    cut = newton_logistic(separable, ["a"])
    assert cut.transform(separable).filter("prediction <> label").count() == 0 and cut.loss < .01
    with pytest.raises(ValueError):
        newton_logistic(df.filter("false"), NAMES)
    with pytest.raises(ValueError):
        newton_logistic(df.withColumn("label", F.col("label") * 2), NAMES)


def three_classes(spark, n=700):
    return spark.range(n).selectExpr("id AS doc_id", "CAST(id % 7 AS DOUBLE) AS a", "sin(id * 3) AS b", "cos(id) AS c",
                                     "CAST((id % 7 > 3) AS INT) + CAST(sin(id * 3) > .2 AS INT) + CAST(id * 31 % 11 = 5 AS INT)"
                                     " AS y").selectExpr("*", "CAST(least(y, 2) AS DOUBLE) AS label").drop("y")


def test_one_fit_serves_all_depths(spark):
    data = assembler(["a", "b", "c"]).transform(fit_table(three_classes(spark), "doc_id"))
    grid = {"numTrees": (3, 10), "maxDepth": (12, 1, 4, 7), "impurity": ("gini", "entropy")}
    f1 = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1")
    shared, each = holdout_search(random_forest(), grid, data), holdout_search(random_forest(), grid, data, evaluator=f1)
    assert shared.candidates == each.candidates and len(shared.metrics) == 16
    assert shared.metrics == pytest.approx(each.metrics, abs=1e-12)
    assert len(set(shared.metrics)) > 4 and shared.partitions == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_weighted_f1():
    assert weighted_f1([]) == 0 and weighted_f1([(0., 0., 5)]) == 1 and weighted_f1([(0., 1., 5)]) == 0


def test_routing_through_the_node_table(spark):
    data = assembler(["a", "b", "c"]).transform(three_classes(spark))
    model = random_forest(num_trees=6, max_depth=9).fit(data)
    nodes = forest_nodes(model)
    assert nodes.count() == model.totalNumNodes and nodes.filter("feature >= 0 AND threshold IS NULL").count() == 0
    scored = model.transform(data).withColumn("raw", vector_to_array("rawPrediction"))
    got = route(scored, nodes, 9, keep=("doc_id", "prediction", "raw")).collect()
    assert len(got) == 700 and all(r.routed == r.prediction and r.votes == pytest.approx(r.raw) for r in got)


def test_rows_carry_no_copy_of_the_forest(spark):
    data = assembler(["a", "b", "c"]).transform(three_classes(spark))
    model = random_forest(num_trees=4, max_depth=8).fit(data)
    by_depth = predictions_by_depth(model, data, [8, 2], keep=("doc_id", "label"))
    routed = route(data, forest_nodes(model), 8)
    for df in (by_depth, routed):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan and "LocalTableScan" not in plan, plan
    assert by_depth.dtypes == [("doc_id", "bigint"), ("label", "double"), ("depth", "int"), ("prediction", "double")]
    for depth in (2, 8):
        want = random_forest(num_trees=4, max_depth=depth).fit(data).transform(data)
        got = {r.doc_id: r.prediction for r in by_depth.filter(F.col("depth") == depth).collect()}
        assert got == {r.doc_id: r.prediction for r in want.collect()} and len(got) == 700
    assert predictions_by_depth(model, data.filter("false"), [2]).collect() == []


def test_forest_arrays(spark):
    """A tree by hand: 0 -> (1 -> (2, 3), 4); 2 and 3 predict alike, 4 differs."""
    rows = [(0, 4, -1, None, -1, -1, [0., 9.]), (0, 0, 0, .5, 1, 4, [8., 9.]), (0, 1, 1, .5, 2, 3, [8., 0.]),
            (0, 2, -1, None, -1, -1, [5., 0.]), (0, 3, -1, None, -1, -1, [3., 0.]), (1, 0, -1, None, -1, -1, [0., 0.])]
    forest = ForestArrays.of(spark.createDataFrame(
        rows, "tree int, node int, feature int, threshold double, left int, right int, counts array<double>"))
    assert forest.roots.tolist() == [0, 5] and forest.level.tolist() == [0, 1, 2, 2, 1, 0]
    top = forest.stops()[2]
    assert forest.stops().tolist() == [0, 1, top, top, top, top] and forest.pruned_stops().tolist() == [0, top, top, top, top, top]
    cut, whole = forest.votes(np.array([[.5, 0.], [.6, 0.]]), forest.stops(), [0, 2])
    assert cut.tolist() == [[8 / 17, 9 / 17]] * 2 and whole.tolist() == [[1., 0.], [0., 1.]]


def test_fewer_fits_at_once_on_larger_tables():
    assert [fits_at_once(8, partitions, 12) for partitions in (1, 3, 8, 24, 1000)] == [8, 8, 3, 2, 2]
    assert fits_at_once(1, 1, 12) == 1


def test_growing_forests_fit_the_drivers_heap():
    """Sizes of the grid's forests: no two large ones at once in little room, all
    done in the end, and one alone when the room is too small for any."""
    sizes = [n for n in range(96, 0, -8) for _ in range(2)]
    for room, most in ((130, 8), (216, 6), (5, 4), (10 ** 6, 3)):
        lock, now, peaks, counts = threading.Lock(), [], [], []

        def run(i):
            with lock:
                now.append(sizes[i])
                peaks.append(sum(now))
                counts.append(len(now))
            time.sleep(.002)
            with lock:
                now.remove(sizes[i])
            return i

        assert sorted(run_all(run, range(len(sizes)), lambda i: sizes[i], most, lambda: room)) == list(range(len(sizes)))
        assert max(peaks) <= max(room, 96) and max(counts) <= most
    with pytest.raises(ZeroDivisionError):
        list(run_all(lambda i: 1 / i, [2, 1, 0], lambda i: 1, 2, lambda: 9))
    assert trees_at_once(10 ** 9, 128_000, []) == 300 and trees_at_once(10 ** 9, 128_000, [500, 1000]) == 600
    assert trees_at_once(10 ** 9, 0, []) > 10 ** 5


def test_layout_follows_from_the_rows_alone(spark, tmp_path):
    assert [FitLayout().count(n) for n in (0, 1, 1 << 16, (1 << 16) + 1, 10 ** 10)] == [1, 1, 1, 2, 152588]
    assert FitLayout(partitions=5).count(10 ** 10) == 5
    rows = three_classes(spark)
    found = {}
    for layout in (FitLayout(), FitLayout(rows_per_partition=100), FitLayout(partitions=3)):
        for files in (1, 16):
            path = str(tmp_path / f"{hash(layout)}-{files}")
            rows.repartition(files).write.parquet(path)
            table = fit_table(spark.read.parquet(path), "doc_id", layout)
            assert layout_of(table) == layout.count(700)
            with kept(assembler(["a", "b", "c"]).transform(table)) as train:
                model = random_forest(num_trees=5, max_depth=6).fit(train)
            found.setdefault(layout, []).append(model.toDebugString.split("\n", 1)[1])
    assert all(a == b for a, b in found.values())
    assert layout_of(fit_table(rows, "doc_id", FitLayout(rows_per_partition=100))) == 7


def test_many_partitions_cut_the_lineage_of_node_ids(spark, monkeypatch):
    """Fits on many partitions checkpoint node ids; trees and metrics are those
    without checkpoints, and no checkpoint is left."""
    table = fit_table(three_classes(spark), "doc_id", FitLayout(partitions=40))
    data = assembler(["a", "b", "c"]).transform(table)
    plain = random_forest(num_trees=5, max_depth=12)
    cut = with_short_lineage(plain, layout_of(data))
    assert (plain.getCheckpointInterval(), cut.getCheckpointInterval()) == (-1, LINEAGE_LEVELS) and cut.uid == plain.uid
    assert with_short_lineage(plain, 31) is plain
    assert with_short_lineage(random_forest(checkpointInterval=7), 40).getCheckpointInterval() == 7
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rdds = lambda: {f.getPath().getName() for f in files.listStatus(folder) if f.getPath().getName().startswith("rdd-")}
    others = rdds()
    with kept(data) as rows:
        trees = [rf.fit(rows).toDebugString.split("\n", 1)[1] for rf in (plain, cut)]
    assert trees[0] == trees[1] and rdds() <= others
    grid, used, fit = {"numTrees": (2, 3), "maxDepth": (3, 9), "impurity": ("gini",)}, [], type(plain).fit
    monkeypatch.setattr(type(plain), "fit", lambda rf, *a: used.append(rf.getCheckpointInterval()) or fit(rf, *a))
    found = [holdout_search(random_forest(**p), grid, data) for p in ({}, {"checkpointInterval": 50})]
    assert used == [LINEAGE_LEVELS] * 2 + [50] * 2 and found[0].metrics == pytest.approx(found[1].metrics, abs=1e-12)


def test_search_sees_a_table_that_changes(spark, tmp_path):
    path = str(tmp_path)
    docs, labels = load_table(spark, SF_SMALL, "documents"), load_table(spark, SF_SMALL, "labels")
    labels.write.parquet(path + "/labels.parquet")
    docs.write.parquet(path + "/documents.parquet")
    grid = {"numTrees": (2,), "maxDepth": (2, 3), "impurity": ("gini",)}
    before = forest_search(spark, path, "lang", .85, grid)[-1]
    assert forest_search(spark, path, "lang", .85, grid)[-1] is before
    docs.filter("doc_id % 2 = 0").write.mode("overwrite").parquet(path + "/documents.parquet")
    after = forest_search(spark, path, "lang", .85, grid)[-1]
    assert after.train_rows < before.train_rows


def test_fingerprint_is_of_the_rows(spark):
    df = spark.range(50).selectExpr("id", "CAST(id AS STRING) AS t")
    assert fingerprint(df) == fingerprint(df.repartition(7)) != fingerprint(df.filter("id > 0"))
    assert fingerprint(df.unionByName(df.filter("id = 1"))) != fingerprint(df.unionByName(df.filter("id = 2")))
