import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sparkclassify.llm.conversations import damage, op11_conversations, repair_reports
from sparkclassify.llm.queries import ORACLE_SQL
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


def cheapest(rows, marks):
    """Dijkstra over (rows consumed, last initial), least (cost, initials)."""
    queue, seen = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, lines = heapq.heappop(queue)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, lines
        if (i, last) in seen:
            continue
        seen.add((i, last))
        new = NEXT[last]
        heapq.heappush(queue, (cost + 2, audit + "I", i, new, lines + (FULL[new] + ":",)))
        if i == len(rows):
            continue
        role, text = rows[i]
        gone, extra = marks[i] in ("blank", "duplicate"), marks[i] == "truncated"
        heapq.heappush(queue, (cost + 3, audit + "D", i + 1, last, lines))
        if not gone:
            heapq.heappush(queue, (cost + 2 + extra, audit + "R", i + 1, new, lines + (f"{FULL[new]}:{text}",)))
            x = role[:1]
            if (x == "s" and last == "") or (x in ("u", "a") and x == new):
                heapq.heappush(queue, (cost + extra, audit + "K", i + 1, x, lines + (f"{role}:{text}",)))


def brute(rows, hurt=True):
    out = {}
    table = []
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        way = zlib.crc32(key.encode()) % 20 if hurt else 9
        if way:
            text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
            table += [(conv, turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    for row in table:
        out[row[0]].append(row[1:])
    result = []
    for conv, mine in out.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        said, marks = set(), []
        for _, role, text in mine:
            solid = re.findall("[^ \t-\r]", text)
            marks.append("blank" if not solid else "duplicate" if (role, text) in said
                         else "truncated" if solid[-1] not in ".!?" else "")
            said.add((role, text))
        turns = {t for t, _, _ in mine if t is not None}
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, lines = cheapest([r[1:] for r in mine], marks)
        result.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, marks.count("blank"),
                       marks.count("duplicate"), marks.count("truncated"), illegal, cost, audit,
                       hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(result, key=str)


def invented(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(convs), None]:
        turn = rng.randint(-2, 3)
        for _ in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User", "unknown"])
            text = rng.choice(["", None, " \n\t", "a", "b.", "c!  ", "d?\r\n", "ü…", "e.x", "f.\x0b"])
            rows.append((conv, rng.choice([turn] * 6 + [None]), role, text))
            turn += rng.choice([0, 1, 1, 1, 2, 5])
    rng.shuffle(rows)
    return rows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("segment", [1, 3, 4096])
def test_against_dijkstra(spark, segment):
    rows = invented(segment, 40, 14)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("conv", "pos", "codes", "goal")})
    df = df.repartition(5)
    assert got(repair_reports(df, segment)) == brute(rows, hurt=False)


def test_one_conversation_with_most_rows(spark):
    rows = invented(7, 5, 6) + [(3, t, "uas"[t % 2] == "u" and "user" or "assistant", f"text {t % 450}.") for t in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert got(repair_reports(df, 50)) == brute(rows, hurt=False)


def test_damage_and_awkward_rows(spark, tmp_path):
    rows = invented(11, 60, 4) + [(900 + i, 0, "user", "Hello.") for i in range(300)]      # many lose all rows
    rows += [(5000, 1, "user", "x" * 3_000_000), (5000, 2, "assistant", "y." * 1_000_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.withColumn("found", F.lit(1)).write.parquet(str(tmp_path / "conversations.parquet"))
    want = brute(rows)
    found = op11_conversations(spark, str(tmp_path))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got(found) == want
    assert any(r[7] == "" for r in want)
    one = spark.createDataFrame(rows, SCHEMA)
    assert damage(one.filter("conv_id = 1")).count() >= 0
    assert repair_reports(one.filter("false")).count() == 0


def test_sql_on_awkward_rows(spark, tmp_path):
    spark.createDataFrame(invented(13, 60, 8), SCHEMA).coalesce(1).write.parquet(str(tmp_path / "t"))
    part = next((tmp_path / "t").glob("*.parquet"))
    part.rename(tmp_path / "conversations.parquet")
    result = compare(spark, "op11", op11_conversations, ORACLE_SQL["op11_conversations"], str(tmp_path))
    assert result["values_match"], result


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert got(op11_conversations(spark, SF_SMALL)) == brute(rows)
