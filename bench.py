"""Benchmark the headline queries.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8) and prints one JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is forced to full evaluation with the ``noop`` sink (a
``count()`` could prune columns and skip work).  Before timing, the
session is warmed up (not timed) with a trivial job and the flagship
query on the smallest scale factor, so JVM start-up and first-use class
loading and JIT compilation are not charged to whichever query runs first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # (bench name, registered query)
    ("text_nb_job", "job_text_naive_bayes"),
    ("text_nb_eval", "job_text_naive_bayes_eval"),
    ("explode_terms", "explode_terms"),
    ("tfidf_l2", "l2_normalize"),
    ("nb_score_docs", "nb_score"),
    ("nb_pipeline_ml", "nb_pipeline"),
    ("rf_predict", "rf_predict"),
    ("tuned_forest", "job_tuned_forest_multiclass"),
    ("logistic", "job_logistic_binary"),
    ("class_metrics", "metric_weighted_f1"),
    ("auroc", "metric_auroc"),
    ("aupr", "metric_aupr"),
    ("hash_split", "hash_split_7525"),
    ("csv_roundtrip", "csv_source"),
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    from sparkclassify.plans.catalog import all_queries
    from sparkclassify.session import get_spark, release_tables
    spark = get_spark("sparkclassify-bench", master=f"local[{cpus}]",
                      shuffle_partitions=max(cpus, 8),
                      extra_conf={"spark.ui.enabled": "false",
                                  "spark.ui.showConsoleProgress": "false",
                                  "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    qs = all_queries()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        qs["job_text_naive_bayes"](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name, query in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.time()
        qs[query](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        release_tables(spark)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
