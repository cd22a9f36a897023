"""Sharding by histogram sort: near-equal bytes, one exchange.

Rows are ordered by a 62-bit key, 32 bits of the text's hash before 20 bits of
the id's and 10 of the row's own, so equal texts stand together.  Keys are
settled with what is kept of the rows.  Splitters of that order are found by
counting: each round counts the exact bytes below candidate key boundaries
(the edges of equal sub-ranges of the key ranges that still hold a splitter),
in every partition with partial sums, and moves each splitter to the nearest
edge.  A splitter is final once it is within tolerance of its target; the
first rounds only offer edges between different texts, so a group of copies
is cut only where keeping it whole would miss the tolerance.  Then the rows
are exchanged once, to blocks, and numbered.

A shard is several blocks of about ``block_bytes``, so the task that numbers a
block's rows is bounded, whatever the shard size; a group of copies that holds
a third of all rows spans many blocks, since its ids differ in the key.  Only
splitters (one row per block) reach the driver.  DataFrame functions only.

Defined results: a null text has no bytes, counts ``row_overhead`` like every
row, and its crc32 is that of the empty text; null ids are ordinary keys; rows
equal in text and id differ in the row's bits, so a third of all rows may be one
row repeated; they are numbered in any order;
an empty table gives an empty result.  Extra columns pass through ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

KEY_BITS = 62
ROUNDS = (12, 10, 10, 10, 10, 10)   # key bits settled per round; the first three are the text's


@dataclass(frozen=True)
class ShardConfig:
    shards: int = 24
    row_overhead: int = 8
    tolerance: float = 0.005         # of a shard's bytes
    block_bytes: int = 256 << 20
    most_blocks: int = 1 << 17       # bounds the splitters on the driver


def shard_key(id_col: str, text_col: str) -> Column:
    """32 bits of the text's hash, 20 of the id's, 10 of the row's own: equal
    texts stand together, and rows repeated whole can still be parted.  The
    row's bits hold once the key is settled."""
    text = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), 32)
    row = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 54)
    return (F.shiftleft(text, 30).bitwiseOR(F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 44), 10))
            .bitwiseOR(row))


def text_size(text_col: str, overhead: int) -> Column:
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + F.lit(overhead)


def _longs(values) -> Column:
    """A constant array; written as text, since it may be long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _probe(sizes: DataFrame, splitters: list[dict], shift: int, below: int):
    """The sub-range that holds each splitter, with the exact bytes and rows
    before it and in it.  ``below``: shift of the ranges already settled."""
    want = sizes.sparkSession.range(1).select(F.inline(F.arrays_zip(
        _longs(s["i"] for s in splitters).alias("i"), _longs(s["range"] for s in splitters).alias("r"),
        _longs(s["target"] - s["bytes"] for s in splitters).alias("want"))))
    ranged = sizes.select(F.shiftright("key", below).alias("r"), F.shiftright("key", shift).alias("s"), "size")
    if below < KEY_BITS:
        # one row per open range, at most one per splitter
        ranged = ranged.join(F.broadcast(want.select("r").distinct()), "r")
    counts = ranged.groupBy("r", "s").agg(F.sum("size").alias("in_bytes"), F.count("*").alias("in_rows"))
    order = Window.partitionBy("r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    running = counts.select(
        "r", "s", "in_bytes", "in_rows",
        F.coalesce(F.sum("in_bytes").over(order), zero).alias("b"),
        F.coalesce(F.sum("in_rows").over(order), zero).alias("n"))
    hit = running.join(F.broadcast(want), "r").filter("b <= want AND want < b + in_bytes")
    return {h["i"]: h for h in hit.select("i", "s", "b", "n", "in_bytes", "in_rows").collect()}


def find_splitters(sizes: DataFrame, config: ShardConfig):
    """``(edges, blocks per shard, total rows)``; an edge is ``(i, key, rows
    below)``, where block ``i`` begins."""
    total, rows = sizes.agg(F.sum("size"), F.count("*")).first()
    if not rows:
        return [], 1, 0
    per_shard = max(1, min(config.most_blocks // config.shards,
                           -(-total // (config.shards * config.block_bytes))))
    count = config.shards * per_shard
    shard_slack = int(config.tolerance * total / config.shards)
    block_slack = max(shard_slack, total // (4 * count)) if per_shard > 1 else shard_slack
    still = [{"i": i, "target": i * total // count, "range": 0, "bytes": 0, "rows": 0} for i in range(1, count)]
    edges, below = [], KEY_BITS
    for bits in ROUNDS:
        shift = below - bits
        found = _probe(sizes, still, shift, below) if still else {}
        rest = []
        for s in still:
            h = found[s["i"]]
            low = s["bytes"] + h["b"]
            miss_low, miss_high = s["target"] - low, low + h["in_bytes"] - s["target"]
            slack = block_slack if s["i"] % per_shard else shard_slack
            if shift and min(miss_low, miss_high) > slack:
                rest.append({**s, "range": h["s"], "bytes": low, "rows": s["rows"] + h["n"]})
            elif miss_low <= miss_high:
                edges.append((s["i"], h["s"] << shift, s["rows"] + h["n"]))
            else:
                edges.append((s["i"], (h["s"] + 1) << shift, s["rows"] + h["n"] + h["in_rows"]))
        still, below = rest, shift
    return sorted(edges), per_shard, rows


def _count_up_to(edges: list[int], key: Column) -> Column:
    """How many of the ascending ``edges`` are at most ``key``, by halving."""
    if not edges:
        return F.lit(0).cast("long")
    steps = len(edges).bit_length()
    table = _longs(edges + [1 << 62] * ((1 << steps) - 1 - len(edges)))
    return F.aggregate(
        _longs([1 << s for s in reversed(range(steps))]), F.lit(0).cast("long"),
        lambda done, step: F.when(F.element_at(table, (done + step).cast("int")) <= key, done + step).otherwise(done))


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep=None,
                  config: ShardConfig = ShardConfig()) -> DataFrame:
    """``keep`` (columns or expressions; all columns by default) with
    ``shard`` (0-based) and ``slot`` (0-based place in the shard) of every
    row; they replace input columns of those names.  Only ``keep`` is settled
    with the keys and goes through the exchange."""
    if keep is None:
        keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")]
    rows = settle(docs.select(F.struct(*keep).alias("row"), shard_key(id_col, text_col).alias("key"),
                              text_size(text_col, config.row_overhead).alias("size")))
    edges, per_shard, _ = find_splitters(rows.select("key", "size"), config)
    edges = sorted((key, rows, i % per_shard == 0) for i, key, rows in edges)
    shard, shard_rows, shards, starts = 0, 0, [0], [0]
    for _, before, opens in edges:
        if opens:
            shard, shard_rows = shard + 1, before
        shards.append(shard)
        starts.append(before - shard_rows)
    placed = rows.withColumn("block", _count_up_to([key for key, _, _ in edges], F.col("key")).cast("int"))
    order = Window.partitionBy("block").orderBy("key")
    at = F.col("block") + 1
    return placed.withColumn("n", F.row_number().over(order)).select(
        "row.*", F.element_at(_longs(shards), at).cast("int").alias("shard"),
        (F.element_at(_longs(starts), at) + F.col("n") - 1).alias("slot"))


def op2_sharding(spark, sf_dir, config: ShardConfig = ShardConfig()):
    """Shard and slot of every row of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    size = text_size("text", config.row_overhead).alias("size")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    return assign_shards(docs, "doc_id", "text", ["doc_id", size, crc], config).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
