"""Conversation structure repair by an auction shortest-path algorithm.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles.  Its
rows are the columns of a lattice whose nodes are (rows consumed, state); the
states are nothing yet, after system, after user, after assistant.  Arcs are
the edits: Keep (0), Rerole to user or assistant (2), Delete (3, the only edit
of a blank or duplicate row), Insert an empty user or assistant row (2); a
truncated row that stays adds 1.  Node prices rise by the auction algorithm: a
path starts at a node; its end is *contracted* when its price is below the
cheapest arc (the price rises to it), else the path is *extended* along that
arc, until it meets a node whose price is known to be exact.  Origins are taken
from the last column to the first, so paths are short.  Converged prices are
distances to the goal; arcs without slack are tight, and the audit follows them
from the start, smallest initial (D, I, K, R) first.

Rows are sorted into range partitions and cut into segments of at most
``SEGMENT`` rows, so a conversation that holds a third of all rows is spread.
For a conversation of several segments, each segment's 4 x 4 matrix of
distances is found on its own, the few numbers of each are chained backwards
(prices at its end) and forwards (its first state) in a stream, and each
segment is then traced on its own.  Only the SHA-256 of a repaired
conversation, sequential by nature, reads its rows one after the other: as a
stream in order, which keeps the digest and the audit.

Defined results: null conversations are one conversation; null turns stand
first; a null role or text is one space (a role without an s, u or a to begin
with is never kept; such a text is blank); rows of one turn stand by role, then
by a digest of the text; a conversation without rows gives zeros and the digest
of the empty string; an empty table gives an empty one; other columns are not
read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import settle

SEGMENT = 4096
WHITE = " \t\n\x0b\f\r"
START, SYSTEM, USER, ASSISTANT = range(4)
# the state after one more user or assistant row, from each state
NEXT = (USER, USER, ASSISTANT, USER)
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
FAR = 1 << 40
# what a row is: its role's initial (0 none, 1 s, 2 u, 3 a), and two marks
CUT, GONE = 4, 8
KEPT_FROM = {1: (START,), 2: (START, SYSTEM, ASSISTANT), 3: (USER,)}


# -- auction on one segment ------------------------------------------------------

def _arcs(code, state):
    """``(letter, columns ahead, next state, cost)`` in order of letters."""
    out = [("D", 1, state, DELETE), ("I", 0, NEXT[state], INSERT)]
    if not code & GONE:
        extra = TRUNCATED if code & CUT else 0
        if state in KEPT_FROM.get(code & 3, ()):
            out.append(("K", 1, code & 3, extra))
        out.append(("R", 1, NEXT[state], REROLE + extra))
    return out


ARCS = {(code, state): _arcs(code, state) for code in range(16) for state in range(4)}


def auction(arcs_at, price, exact):
    """Raise the prices of one column until each is exact.  ``price`` are the
    column's (a lower bound), ``exact[s]`` marks those known; an arc is ``(cost,
    next state in the column or None, price beyond)``."""
    for origin in range(4):
        path = [origin]
        while not exact[path[-1]]:
            end = path[-1]
            cost, to = min((c + (beyond if s is None else price[s]), -1 if s is None else s)
                           for c, s, beyond in arcs_at[end])
            if cost >= FAR:
                price[end], exact[end] = FAR, True
            elif price[end] < cost:                    # contract
                price[end] = cost
                if len(path) > 1:
                    path.pop()
            elif to < 0:                               # extend, to an exact price
                break
            else:
                path.append(to)
        for s in path:
            exact[s] = True
    return price


def last_column():
    """Prices after the last row: only inserts, or the end."""
    goal = {START: 0, ASSISTANT: 0}
    arcs = [[(INSERT, NEXT[s], 0)] + ([(goal[s], None, 0)] if s in goal else []) for s in range(4)]
    return tuple(auction(arcs, [0, 0, 0, 0], [False] * 4))


END = last_column()


def prices(codes, goal):
    """Distances to the goal from every node, column by column."""
    out = [None] * len(codes) + [goal]
    for i in range(len(codes) - 1, -1, -1):
        beyond = out[i + 1]
        arcs = [[(c, None if step else s, beyond[s] if step else 0) for _, step, s, c in ARCS[codes[i], state]]
                for state in range(4)]
        # The goal out of reach: users and assistants lead to neither of the
        # other states, and the start is entered by nothing.
        lost = min(beyond[USER], beyond[ASSISTANT]) >= FAR
        price = [0, 0, FAR if lost else 0, FAR if lost else 0]
        out[i] = auction(arcs, price, [False, False, lost, lost])
    return out


def distances(codes) -> list[int]:
    """16 distances, from each state before the segment to each after it."""
    by_end = []
    for end in range(4):
        by_end.append(prices(codes, [0 if s == end else FAR for s in range(4)])[0])
    return [by_end[end][start] for start in range(4) for end in range(4)]


def trace(codes, goal, state, final):
    """``(edits, last state)`` along tight arcs, least letters first: for each
    row the roles inserted before it and what becomes of it (``K``, ``D``, or
    ``U``, ``A`` for its new role); one more entry for what follows the last
    row."""
    price, edits = prices(codes, goal), []
    for i, code in enumerate(codes):
        edit = ""
        while True:
            letter, step, to = next((x, step, s) for x, step, s, c in ARCS[code, state]
                                    if price[i][state] == c + price[i + step][s])
            if step:
                break
            edit, state = edit + " sua"[to], to
        edits.append(edit + (" SUA"[to] if letter == "R" else letter))
        state = to
    tail = ""
    while final and price[-1][state]:
        state = NEXT[state]
        tail += " sua"[state]
    return edits + [tail], state


@lru_cache(1 << 14)
def _whole(codes: bytes):
    return trace(codes, END, START, True)[0]


# -- the job -----------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` damaged by a checksum of
    conversation and turn: dropped, emptied, without full stops, repeated, or
    made the user's."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    hurt = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), way.alias("way"))
    return hurt.filter("way <> 0").select(
        "conv_id", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("way") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _in_order(rows: DataFrame) -> DataFrame:
    """``rows`` with ``pos``, increasing in the order of conversations and
    turns; range partitions, so no conversation is bound to one task."""
    keyed = rows.select(F.col("conv_id").alias("conv"), "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"))
    keyed = keyed.withColumn("same", F.sha2("text", 256)).withColumn("row", F.monotonically_increasing_id())
    order = ["conv", "turn", "role", "same", "row"]
    return settle(keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
                  .withColumn("pos", F.monotonically_increasing_id()))


def _marked(ordered: DataFrame) -> DataFrame:
    """``(conv, pos, code)``: each row's initial and first fault."""
    rest = F.rtrim("text", F.lit(WHITE))
    light = settle(ordered.select(
        "conv", "pos", (rest == "").alias("blank"),
        (~F.substring(rest, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.instr(F.lit("sua"), F.substring("role", 1, 1)).alias("initial"), F.length("role").alias("has_role"),
        F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "same"), 256)).alias("said")))
    first = light.filter("NOT blank").groupBy("conv", "said").agg(F.min("pos").alias("pos"))
    marked = light.join(first.select("pos", F.lit(True).alias("first")), "pos", "left")
    gone = F.col("blank") | F.col("first").isNull()
    return marked.select("conv", "pos", (
        F.when(F.col("has_role") == 0, 0).otherwise(F.col("initial"))
        + F.when(~gone & F.col("cut"), CUT).otherwise(0) + F.when(gone, GONE).otherwise(0)).alias("code"))


def _segments(marked: DataFrame, segment: int) -> DataFrame:
    """``(conv, at, codes, whole)``: runs of at most ``segment`` rows of one
    conversation, and whether that is all of it."""
    part = [F.col("conv"), F.shiftright("pos", 33).alias("p"),
            F.floor(F.col("pos").bitwiseAND((1 << 33) - 1) / segment).alias("s")]
    runs = settle(marked.groupBy(*part).agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("r")).select(
        "conv", F.col("r")[0]["pos"].alias("at"), F.transform("r", lambda x: x["code"].cast("int")).alias("codes")))
    several = runs.groupBy(F.col("conv").alias("of")).count().filter("count > 1").select("of", F.lit(True).alias("several"))
    return settle(runs.join(several, runs.conv.eqNullSafe(several.of), "left").select(
        "conv", "at", "codes", F.col("several").isNull().alias("whole")))


def _mapped(df: DataFrame, schema: str, each) -> DataFrame:
    """``each(rows)`` yields tuples from dictionaries, batch by batch."""
    kind = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        def rows():
            for batch in batches:
                for k in range(0, batch.num_rows, 256):
                    yield from batch.slice(k, 256).to_pylist()
        held = []
        for out in each(rows()):
            held.append(out)
            if len(held) == 256:
                yield _batch(held, kind)
                held = []
        if held:
            yield _batch(held, kind)

    return df.mapInArrow(run, schema)


def _batch(rows, kind):
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), kind)], schema=kind)


def _with_matrix(rows):
    for r in rows:
        yield r["conv"], r["at"], r["codes"], distances(r["codes"])


def _backwards(rows):
    """Prices at each segment's end, from each conversation's last to first."""
    goal, conv, fresh = None, None, True
    for r in rows:
        final = fresh or r["conv"] != conv
        conv, fresh = r["conv"], False
        if final:
            goal = list(END)
        yield conv, r["at"], r["codes"], goal, final
        m = r["matrix"]
        goal = [min(m[4 * s + t] + goal[t] for t in range(4)) for s in range(4)]


def _with_exits(rows):
    for r in rows:
        exits = [trace(r["codes"], r["goal"], s, False)[1] for s in range(4)]
        yield r["conv"], r["at"], r["codes"], r["goal"], r["final"], exits


def _forwards(rows):
    """The state before each segment, and the code of the row before it."""
    conv, state, before, fresh = None, START, -1, True
    for r in rows:
        if fresh or r["conv"] != conv:
            conv, state, before, fresh = r["conv"], START, -1, False
        yield conv, r["at"], r["codes"], r["goal"], r["final"], state, before
        state, before = r["exits"][state], r["codes"][-1]


def _edits(rows):
    """One row per row of the conversation, and one for what follows it."""
    legal = {(1, 2), (2, 3), (3, 2)}
    for r in rows:
        codes = r["codes"]
        edits = (_whole(bytes(codes)) if r["goal"] is None
                 else trace(codes, r["goal"], r["state"], r["final"])[0])
        before = -1 if r["before"] is None else r["before"]
        for i, code in enumerate(codes):
            wrong = before >= 0 and (before & 3, code & 3) not in legal
            yield r["conv"], r["at"] + i, 0, edits[i], code, wrong
            before = code
        if edits[-1]:
            yield r["conv"], r["at"] + len(codes) - 1, 2, edits[-1], 0, False


def _edit_table(segments: DataFrame, conv_type: str) -> DataFrame:
    base = f"conv {conv_type}, at long, codes array<int>"
    part = segments.filter("NOT whole").select("conv", "at", "codes")
    matrix = _mapped(part.repartition("conv", "at"), base + ", matrix array<long>", _with_matrix)
    goal = _mapped(matrix.repartition("conv").sortWithinPartitions(F.desc("at")),
                   base + ", goal array<long>, final boolean", _backwards)
    exits = _mapped(goal.repartition("conv", "at"), base + ", goal array<long>, final boolean, exits array<int>", _with_exits)
    known = _mapped(exits.repartition("conv").sortWithinPartitions("at"),
                    base + ", goal array<long>, final boolean, state int, before int", _forwards)
    whole = segments.filter("whole").select(
        "conv", "at", "codes", F.lit(None).cast("array<long>").alias("goal"), F.lit(True).alias("final"),
        F.lit(START).alias("state"), F.lit(-1).alias("before"))
    return _mapped(known.repartition("conv", "at").unionByName(whole),
                   f"conv {conv_type}, pos long, ord int, edit string, code int, wrong boolean", _edits)


ROLE = {"u": "user", "a": "assistant", "U": "user", "A": "assistant"}


class _Report:
    """What a stream of one conversation's edits and rows adds up to."""

    def __init__(self, conv):
        self.conv, self.digest, self.audit, self.any = conv, hashlib.sha256(), [], False
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0

    def line(self, role, text):
        self.digest.update(("\n" if self.any else "").encode() + f"{role}:{text}".encode())
        self.any = True

    def inserted(self, roles):
        for x in roles:
            self.line(ROLE[x], "")
        self.audit.append("I" * len(roles))
        self.cost += INSERT * len(roles)

    def row(self, edit, code, wrong, r):
        self.inserted(edit[:-1])
        act = edit[-1]
        self.audit.append("R" if act in "UA" else act)
        if act != "D":
            self.line(r["role"] if act == "K" else ROLE[act], r["text"])
        self.cost += DELETE if act == "D" else (REROLE if act in "UA" else 0) + (TRUNCATED if code & CUT else 0)
        empty = not r["text"].strip(WHITE)
        self.blank += empty
        self.duplicate += bool(code & GONE) and not empty
        self.truncated += bool(code & CUT)
        self.illegal += wrong
        turn = r["turn"]
        if turn is not None:
            if self.high is None or turn != self.high:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def result(self):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
                "".join(self.audit), self.digest.hexdigest())


def _reports(rows):
    now, edit = None, None
    for r in rows:
        if now is None or r["conv"] != now.conv:
            if now is not None:
                yield now.result()
            now = _Report(r["conv"])
        if r["ord"] == 0:
            edit = r
        elif r["ord"] == 1:
            now.row(edit["edit"], edit["code"], edit["wrong"], r)
        else:
            now.inserted(r["edit"])
    if now is not None:
        yield now.result()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_reports(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text)``: its
    faults, the cost of its cheapest repair, the edits' initials and the
    digest of the repaired conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    turn = rows.schema["turn"].dataType.simpleString()
    ordered = _in_order(rows)
    edits = _edit_table(_segments(_marked(ordered), segment), kind)
    texts = ordered.select("conv", "pos", F.lit(1).alias("ord"), "turn", "role", "text")
    both = edits.unionByName(texts, allowMissingColumns=True).select(
        "conv", "pos", "ord", "edit", "code", "wrong", F.col("turn").cast(turn), "role", "text")
    schema = f"conv {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    return _mapped(both.repartition("conv").sortWithinPartitions("pos", "ord"), schema, _reports).withColumnRenamed("conv", "conv_id")


def op11_conversations(spark, sf_dir):
    """Every conversation of ``conversations``, damaged and repaired."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = repair_reports(damage(rows)).withColumnRenamed("conv_id", "found")
    every = rows.select("conv_id").distinct()
    return every.join(found, every.conv_id.eqNullSafe(found.found), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


_STEP = lambda node, letter, cost, line: (
    f"CASE WHEN {node} IS NOT NULL THEN {{'c': {node}.c + {cost}, 'a': {node}.a || '{letter}', 't': {node}.t || {line}}} END")
_LEAST = lambda *nodes: f"list_min([{', '.join(nodes)}])"
_INTO_U = [_STEP(f"p.{s}", "I", 2, "'user:' || chr(10)") for s in ("n0", "ns", "na")]
OP11_SQL = f"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda n: list_reduce(
    [n] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END)) AS t),
h AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295::BIGINT, list_reduce(
    [4294967295::BIGINT] || list_transform(
      string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS way
  FROM conversations, tab),
d AS (
  SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN way = 1 THEN '' WHEN way = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN way = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE way <> 0)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM d),
q AS (
  SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, left(role, 1) AS x,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS y FROM o),
r AS (
  SELECT *, blank OR again AS gone, CASE WHEN NOT blank AND NOT again AND cut THEN 1 ELSE 0 END AS extra,
    count(*) OVER (PARTITION BY conv_id) AS rows FROM q),
p0 AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': ''}} AS n0,
    CASE WHEN false THEN {{'c': 0, 'a': '', 't': ''}} END AS ns, CASE WHEN false THEN {{'c': 0, 'a': '', 't': ''}} END AS nu,
    CASE WHEN false THEN {{'c': 0, 'a': '', 't': ''}} END AS na FROM (SELECT DISTINCT conv_id FROM conversations)),
walk AS (
  SELECT * FROM p0
  UNION ALL
  SELECT conv_id, i,
    {_STEP('n0', 'D', 3, "''")},
    {_LEAST(_STEP('ns', 'D', 3, "''"), "CASE WHEN NOT gone AND x = 's' THEN " + _STEP('n0', 'K', 'extra', "role || ':' || text || chr(10)") + " END")},
    {_LEAST(_STEP('nu0', 'D', 3, "''"),
            *["CASE WHEN NOT gone AND x = 'u' THEN " + _STEP(s, 'K', 'extra', "role || ':' || text || chr(10)") + " END" for s in ('n0', 'ns', 'na0')],
            *["CASE WHEN NOT gone THEN " + _STEP(s, 'R', '2 + extra', "'user:' || text || chr(10)") + " END" for s in ('n0', 'ns', 'na0')])},
    {_LEAST(_STEP('na0', 'D', 3, "''"),
            "CASE WHEN NOT gone AND x = 'a' THEN " + _STEP('nu0', 'K', 'extra', "role || ':' || text || chr(10)") + " END",
            "CASE WHEN NOT gone THEN " + _STEP('nu0', 'R', '2 + extra', "'assistant:' || text || chr(10)") + " END")}
  FROM (SELECT *, {_LEAST('na', _STEP('nu0', 'I', 2, "'assistant:' || chr(10)"))} AS na0 FROM (
    SELECT r.*, p.n0, p.ns, p.na, {_LEAST('p.nu', *_INTO_U)} AS nu0
    FROM walk p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1))),
last AS (
  SELECT conv_id, {_LEAST('n0', 'na', _STEP('nu0', 'I', 2, "'assistant:' || chr(10)"))} AS best FROM (
    SELECT p.*, {_LEAST('p.nu', *_INTO_U)} AS nu0 FROM walk p
    WHERE i = (SELECT count(*) FROM r WHERE r.conv_id IS NOT DISTINCT FROM p.conv_id))),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate, sum(extra) AS truncated,
    count(*) FILTER (y IS NOT NULL AND y || x NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT last.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit,
  sha256(CASE WHEN best.t = '' THEN '' ELSE left(best.t, length(best.t) - 1) END) AS repaired_sha256
FROM last LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM last.conv_id"""
