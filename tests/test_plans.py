"""Physical-plan properties the design relies on."""

import re

from pyspark.sql import functions as F

from sparkclassify.operators.metrics import area_under_roc, class_table
from sparkclassify.operators.sampling import hash_split
from sparkclassify.operators.text_model import fit_text_vectors, score_text_vectors
from sparkclassify.plans.common import SPLIT_SEED, line_terms
from sparkclassify.plans.metric_queries import quality_scores

from .conftest import SF_MEDIUM


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str):
    return re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)


def test_text_job_is_row_local(spark):
    """From text to score no exchange but the one that spreads a narrow scan."""
    train, test = hash_split(line_terms(spark, SF_MEDIUM), ["doc_id"], [0.8, 0.2], SPLIT_SEED)
    model = fit_text_vectors(train)
    plan = _plan(score_text_vectors(model, test, ["doc_id", "line_no", "label"]))
    assert len(_exchanges(plan)) <= 1 and "Join" not in plan and "Aggregate" not in plan, plan
    assert "Python" not in plan


def test_class_table_reads_the_pairs_once(spark):
    pairs = quality_scores(spark, SF_MEDIUM)
    plan = _plan(class_table(pairs, "prediction", "label"))
    assert plan.count("FileScan") == _plan(pairs).count("FileScan"), plan


def test_no_text_goes_through_the_label_join(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(quality_scores(spark, SF_MEDIUM))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    above = plan[:plan.index("SortMergeJoin")] + plan[plan.index("SortMergeJoin"):].split("Project")[0]
    assert "text" not in above, plan


def test_scan_prunes_columns(spark):
    plan = _plan(quality_scores(spark, SF_MEDIUM).select("score", "label"))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert any(s == "struct<doc_id:bigint,text:string>" for s in schemas), schemas
    assert not any("lang" in s or "source" in s for s in schemas), schemas


def test_curve_sorts_in_blocks_not_one_task(spark):
    scored = quality_scores(spark, SF_MEDIUM)
    plan = _plan(area_under_roc(scored, num_blocks=4))
    running = [ln for ln in plan.splitlines() if re.search(r"\bWindow \[", ln) and "score" in ln]
    assert running and all(re.search(r"\], \[_block#\d+\], \[score", ln) for ln in running), running


def test_hot_document_lines_spread_over_tasks(spark):
    """One document with most of all lines: after the exchange by
    (doc_id, line_no) no task holds much more than its share."""
    from sparkclassify.operators.partitioning import by_key
    from sparkclassify.sources.lines import explode_lines
    big = "\n".join(f"line {i}" for i in range(4000))
    docs = spark.createDataFrame([(0, big)] + [(i, "a\nb") for i in range(1, 200)],
                                 "doc_id long, text string")
    lines = by_key(explode_lines(docs, keep=("doc_id",)), ["doc_id", "line_no"], 8)
    sizes = [r["n"] for r in lines.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 8
    assert max(sizes) < 0.2 * sum(sizes), sizes
