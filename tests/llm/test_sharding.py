import zlib

import pytest
from pyspark.sql import functions as F

from sparkclassify.llm.sharding import ShardConfig, assign_shards, op2_sharding

from . import cases


@pytest.mark.parametrize("config", [ShardConfig(), ShardConfig(block_bytes=1 << 14), ShardConfig(shards=5, tolerance=0.0)])
def test_given_documents(spark, config):
    from tests.conftest import SF_MEDIUM
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MEDIUM}/documents.parquet").collect()}
    rows = op2_sharding(spark, SF_MEDIUM, config).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    size, slots = [0] * config.shards, [[] for _ in range(config.shards)]
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    largest = max(r.size for r in rows)
    assert max(size) - min(size) <= 2 * largest + 2 * config.tolerance * sum(size) / config.shards
    assert all(sorted(s) == list(range(len(s))) for s in slots)


def test_awkward_rows(spark):
    docs = cases.documents(spark)
    rows = assign_shards(docs, config=ShardConfig(shards=3)).collect()
    assert len(rows) == docs.count()
    for shard in range(3):
        slots = [r.slot for r in rows if r.shard == shard]
        assert sorted(slots) == list(range(len(slots)))
    assert {r.shard for r in rows} <= {0, 1, 2}
    assert assign_shards(cases.empty(docs)).collect() == []
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    assert [r[0] for r in docs.filter("text IS NULL").select(crc).collect()] == [0, 0]


def test_a_hot_text_is_cut_evenly(spark):
    hot = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, concat('t', id), repeat('hot text ', 5)) AS text")
    rows = assign_shards(hot, config=ShardConfig(shards=8)).groupBy("shard").agg(
        F.sum(F.octet_length("text") + 8).alias("s")).collect()
    sizes = [r.s for r in rows]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 0.05 * max(sizes)


def test_a_row_repeated_whole_is_cut_evenly(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS doc_id", "if(id % 3 = 0, 'one row again', concat('t', id)) AS text")
    placed = assign_shards(rows.repartition(5)).collect()
    size, slots = [0] * 24, [[] for _ in range(24)]
    for r in placed:
        size[r.shard] += len(r.text) + 8
        slots[r.shard].append(r.slot)
    assert len(placed) == 3000 and max(size) - min(size) <= 0.05 * max(size)
    assert all(sorted(s) == list(range(len(s))) for s in slots)


def test_main_path_runs_no_python(spark):
    docs = spark.range(50).selectExpr("id AS doc_id", "repeat('x', int(id)) AS text")
    plan = assign_shards(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
