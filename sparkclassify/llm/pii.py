"""Personal data: exact base kinds, and terms that disclose them.

Base kinds (email, ip, card, phone) are found by patterns and checks.  Terms
are found by information-theoretic sanitisation: over the whole corpus it is
counted how many documents hold a term and a protected value (a base match, by
kind and lower-cased text), and how many hold each at all.  With
``PMI(e; t) = log2(p(e,t) / (p(e) p(t)))`` and ``IC(e) = -log2 p(e)``, the term
discloses the share ``PMI / IC`` of what the value says.  Wherever it stands in
a text that holds the value, a term over ``remove_share`` is removed and one
over ``generalise_share`` is replaced by the word "term", if at least
``support`` different texts show the pair.  Documents without a protected value
are left alone.

Terms are counted against the values that ``support`` different texts hold, as
no other value can have a pair.  Copies of a text are counted as one text with
a weight, so they count in the probabilities but only once for the support.
Counts combine before each exchange.  DataFrame functions only; of the texts,
only those with such values go through an exchange, except in ``sanitise``.
The SQL follows the same rule over whole texts.

Defined results: null is the empty text and stays null when sanitised; an
empty table gives an empty result; repeated rows are equal texts; positions
are code points, ends exclusive; what a value leaves of a word it touches is a
term only if that stands as a word elsewhere.  Other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

# The base kinds in their order, and the characters of their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"

# The patterns take the longest run at once (possessive), which finds the same
# matches, and start an address only at the start of its run, or where the
# match before it ended: a long run is then read once.
_PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_TERM = r"\p{L}{3,}"
TERM = "term"


@dataclass(frozen=True)
class PiiConfig:
    support: int = 3
    generalise_share: float = 0.8
    remove_share: float = 0.95


def _may_hold(kind: str, text: Column) -> Column:
    """A cheap test that no text with a match fails."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9][\x20-]?[0-9]")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    size = F.length(digits)

    def add(total, i):
        digit = F.substring(digits, i, 1).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when((size - i) % 2 == 0, digit).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _located(matches: Column, pieces: Column, offset: Column) -> Column:
    """``(start, end, value)`` of ``matches``, given the text between them."""
    lengths = F.zip_with(pieces, matches, lambda p, m: F.struct(
        F.length(p).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("size")))
    begin = F.struct(offset.cast("int").alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(
        lengths, begin,
        lambda acc, x: F.struct((acc["at"] + x["gap"] + x["size"]).alias("at"),
                                F.concat(acc["starts"], F.array(acc["at"] + x["gap"])).alias("starts")),
        lambda acc: acc["starts"])
    return F.transform(
        F.arrays_zip(F.slice(starts, F.lit(1), F.size(matches)).alias("start"), matches.alias("value")),
        lambda x: F.struct(x["start"].alias("start"), (x["start"] + F.length(x["value"])).alias("end"),
                           x["value"].alias("value")))


_SPAN = "array<struct<start:int,end:int,kind:int,value:string>>"
_PLACES = "array<struct<start:int,end:int,removed:boolean>>"


def base_spans(docs: DataFrame, text_col: str, keep) -> DataFrame:
    """``keep``, the text (null as empty) and its base spans, ordered."""
    taken = [F.col(f"`{c}`") for c in keep]
    df = docs.select(*taken, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    text = F.col("__text")
    # one projection each, so that a pattern runs once per text
    df = df.select("*", *[
        F.when(_may_hold(k, text), F.regexp_extract_all(text, F.lit(_PATTERNS[k]), F.lit(0))).alias(f"__m_{k}")
        for k in KINDS])
    df = df.select("*", *[
        F.when(F.size(f"__m_{k}") > 0, F.split(text, _PATTERNS[k], -1)).alias(f"__p_{k}") for k in KINDS])
    def spans_of(rank, kind):
        matches = F.col(f"__m_{kind}")
        found = F.filter(_located(matches, F.col(f"__p_{kind}"), F.lit(0)), lambda s: _valid(kind, s["value"]))
        spans = F.transform(found, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(rank).alias("kind"), s["value"].alias("value")))
        return F.when(F.size(matches) > 0, spans).otherwise(F.array().cast(_SPAN))

    arrays = [spans_of(rank, kind) for rank, kind in enumerate(KINDS)]
    ordered = F.array_sort(F.transform(F.concat(*arrays), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"))))
    return df.select(*taken, "__text", ordered.alias("__base"))


def _value_key(span) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat(F.element_at(names, span["kind"] + 1), F.lit(":"), F.lower(span["value"]))


def _without_base(text: Column, base: Column) -> Column:
    """``text`` with spaces for its base spans: all other words keep their places."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(
        base, begin,
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.concat(acc["out"], F.array(
                F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"])),
                F.repeat(F.lit(" "), F.greatest(F.lit(0), s["end"] - F.greatest(acc["at"], s["start"]))))).alias("out")),
        lambda acc: F.concat(F.concat_ws("", acc["out"]), F.substring(text, acc["at"] + 1, F.length(text))))


def _terms_of(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)), F.lower))


def _places(text: Column, removed: Column, shown: Column) -> Column:
    """``(start, end, removed)`` of each word of ``text`` in one of the lists;
    only what is found is gathered, so a long text costs its words."""
    words = F.zip_with(
        F.split(text, _TERM, -1), F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)),
        lambda p, w: F.struct(
            F.length(p).alias("gap"), F.coalesce(F.length(w), F.lit(0)).alias("size"),
            F.when(F.array_contains(removed, F.lower(w)), True).when(F.array_contains(shown, F.lower(w)), False).alias("removed")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_PLACES).alias("out"))
    return F.aggregate(
        words, begin,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["size"]).alias("at"),
            F.when(x["removed"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["size"]).alias("end"),
                x["removed"].alias("removed"))))).alias("out")),
        lambda acc: acc["out"])


def disclosing_pairs(found: DataFrame, held: DataFrame, docs: DataFrame, text_col: str, config: PiiConfig) -> DataFrame:
    """``(e, t, removed)`` of the pairs over a threshold.  ``found`` has the
    number ``row`` and the text ``free`` of values of rows with values; ``held``
    has ``(row, copies, e)``, one row of each such text and each of its values."""
    total = docs.agg(F.count("*").cast("double").alias("d"))
    values = held.groupBy("e").agg(F.sum("copies").alias("n_e"), F.count("*").alias("texts")).filter(
        F.col("texts") >= config.support).drop("texts")
    known = (held.join(values.select("e"), "e", "left_semi").groupBy("row")
             .agg(F.max("copies").alias("copies"), F.collect_list("e").alias("es")))
    both = (found.join(known, "row").select("copies", "es", F.explode(_terms_of(F.col("free"))).alias("t"))
            .select("copies", "t", F.explode("es").alias("e")))
    pairs = settle(both.groupBy("e", "t").agg(F.sum("copies").alias("n_et"), F.count("*").alias("texts"))
                   .filter(F.col("texts") >= config.support))
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower(F.col(text_col)), F.lit(_TERM), F.lit(0)))).alias("t"))
    terms = words.groupBy("t").agg(F.count("*").alias("n_t"))
    share = F.log2(F.col("n_et") * F.col("d") / (F.col("n_e") * F.col("n_t"))) / F.log2(F.col("d") / F.col("n_e"))
    scored = (pairs.join(values, "e").join(terms, "t").withColumn("d", total.scalar())
              .filter(F.col("n_e") < F.col("d")).withColumn("share", F.round(share, 9)))
    return scored.filter(F.col("share") >= config.generalise_share).select(
        "e", "t", (F.col("share") >= config.remove_share).alias("removed"))


def _analysed(docs: DataFrame, text_col: str, keep, config: PiiConfig):
    """(rows with their base spans, term spans by text hash)."""
    spans = base_spans(docs, text_col, keep)
    base = F.col("__base")
    rows = settle(spans.select(
        *[F.col(f"`{c}`") for c in keep], F.xxhash64("__text").alias("__h"), "__base",
        F.monotonically_increasing_id().alias("__row"),
        F.when(F.size(base) > 0, _without_base(F.col("__text"), base)).alias("__free")))
    valued = rows.filter(F.size(base) > 0)
    found = valued.select(F.col("__row").alias("row"), F.col("__h").alias("h"), F.col("__free").alias("free"))
    texts = found.groupBy("h").agg(F.min("row").alias("row"), F.count("*").alias("copies")).drop("h")
    held = settle(valued.select(F.col("__row").alias("row"), F.array_distinct(F.transform("__base", _value_key)).alias("es"))
                  .join(texts, "row").select("row", "copies", F.explode("es").alias("e")))
    pairs = disclosing_pairs(found.drop("h"), held, docs, text_col, config)
    of_value = pairs.groupBy("e").agg(F.collect_list(F.when(F.col("removed"), F.col("t"))).alias("removed"),
                                      F.collect_list(F.when(~F.col("removed"), F.col("t"))).alias("shown"))
    lists = (held.join(of_value, "e").groupBy("row")
             .agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("removed", "shown")]))
    own = found.join(lists, "row").withColumn("own", _terms_of(F.col("free"))).select(
        "h", "free", *[F.array_intersect("own", c).alias(c) for c in ("removed", "shown")])
    terms = (own.filter(F.size("removed") + F.size("shown") > 0)
             .select(F.col("h").alias("__h"), _places(F.col("free"), F.col("removed"), F.col("shown")).alias("__terms")))
    return rows.drop("__row", "__free"), terms


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       config: PiiConfig = PiiConfig()) -> DataFrame:
    """``id_col``, counts by kind, the digest of the base spans and all spans
    as ``kind:start:end`` of every row."""
    rows, terms = _analysed(docs, text_col, [id_col], config)
    names = F.array(*map(F.lit, (*KINDS, TERM)))
    base = F.transform("__base", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    more = F.transform(F.coalesce("__terms", F.array().cast(_PLACES)),
                       lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["end"].alias("end")))
    named = lambda spans: F.transform(F.array_sort(spans), lambda s: F.struct(
        F.element_at(names, s["kind"] + 1).alias("name"), s["start"].alias("start"), s["end"].alias("end")))
    count = lambda rank: F.size(F.filter("__base", lambda s: s["kind"] == rank)).cast("long")
    counts = [count(rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS)]
    return rows.join(terms, "__h", "left").select(
        id_col, *counts, F.sha2(_joined(named(base)), 256).alias("base_sha256"),
        _joined(named(F.concat(base, more))).alias("spans"))


def sanitise(docs: DataFrame, text_col: str = "text", config: PiiConfig = PiiConfig()) -> DataFrame:
    """The rows with personal data replaced by its kind in brackets,
    generalised terms by ``[term]``, removed terms by nothing; all other
    columns and texts unchanged."""
    _, terms = _analysed(docs, text_col, [], config)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col(f"`{text_col}`").alias("raw"),
                         F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("__h"))
    keyed = base_spans(packed, "raw", ["row", "raw", "__h"]).join(terms, "__h", "left")
    text = F.col("raw")
    tags = F.array(*[F.lit(f"[{k}]") for k in (*KINDS, TERM)])
    base = F.transform("__base", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.element_at(tags, s["kind"] + 1).alias("tag")))
    more = F.transform(F.coalesce("__terms", F.array().cast(_PLACES)),
                       lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(
                           s["removed"], F.lit("")).otherwise(f"[{TERM}]").alias("tag")))
    # of overlapping spans the first one's tag stands for all
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rewritten = F.aggregate(
        F.array_sort(F.concat(base, more)), begin,
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(F.struct(
                s["end"].alias("at"), F.concat(acc["out"], F.array(
                    F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), s["tag"])).alias("out"))),
        lambda acc: F.concat(F.concat_ws("", acc["out"]), F.substring(text, acc["at"] + 1, F.length(text))))
    touched = (F.size("__base") > 0) | F.col("__terms").isNotNull()
    return keyed.select(*[
        F.when(touched, rewritten).otherwise(text).alias(c) if c == text_col else F.col("row")[c].alias(c)
        for c in docs.columns])


def op4_personal_data(spark, sf_dir):
    """Spans of personal data in every row of ``documents``."""
    return find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _oracle_sql(config: PiiConfig = PiiConfig()) -> str:
    """The same in DuckDB SQL, with the patterns as the contract gives them."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    valid = {
        "email": "true",
        "ip": "len([x FOR x IN string_split(v, '.') IF CAST(x AS HUGEINT) > 255]) = 0",
        "card": """length(g) BETWEEN 14 AND 19 AND list_sum([CASE WHEN (length(g) - j) % 2 = 0 THEN CAST(g[j] AS INTEGER)
          ELSE 2 * CAST(g[j] AS INTEGER) - CASE WHEN g[j] > '4' THEN 9 ELSE 0 END END FOR j IN range(1, length(g) + 1)]) % 10 = 0""",
        "phone": "length(g) BETWEEN 10 AND 15"}
    pieces = "\nUNION ALL ".join(f"""SELECT r, {k} AS kind, '{name}' AS name,
    unnest(regexp_extract_all(text, '{patterns[name]}')) AS v,
    unnest(string_split_regex(text, '{patterns[name]}')[1:len(regexp_extract_all(text, '{patterns[name]}'))]) AS gap,
    unnest(range(len(regexp_extract_all(text, '{patterns[name]}')))) AS i FROM d""" for k, name in enumerate(KINDS))
    checks = " ".join(f"WHEN kind = {k} THEN {valid[name]}" for k, name in enumerate(KINDS))
    term = r"\p{L}{3,}"
    place = """sum(length(gap)) OVER (PARTITION BY {by} ORDER BY i)
    + coalesce(sum(length({v})) OVER (PARTITION BY {by} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"""
    counts = ", ".join(f"CAST(coalesce(count(*) FILTER (kind = {k}), 0) AS BIGINT) AS n_{name}" for k, name in enumerate(KINDS))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
pieces AS ({pieces}),
placed AS (SELECT r, kind, name, v, {place.format(by='r, kind', v='v')} AS a, regexp_replace(v, '[^0-9]', '', 'g') AS g FROM pieces),
base AS (SELECT r, kind, name, v, a, a + length(v) AS b FROM placed WHERE CASE {checks} END),
held AS (SELECT DISTINCT r, name || ':' || lower(v) AS e FROM base),
value AS (
  SELECT e, count(*) AS n_e FROM held JOIN d USING (r) GROUP BY e HAVING count(DISTINCT text) >= {config.support}),
shared AS (SELECT r, e FROM held WHERE e IN (SELECT e FROM value)),
gaps AS (
  SELECT r, coalesce(max(b) OVER (PARTITION BY r ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l,
    a AS u FROM base WHERE r IN (SELECT r FROM shared)
  UNION ALL SELECT r, max(b), length(any_value(text)) FROM base JOIN d USING (r) WHERE r IN (SELECT r FROM shared) GROUP BY r),
parts AS (SELECT r, l, text[l + 1:u] AS c FROM gaps JOIN d USING (r) WHERE l < u),
found AS (
  SELECT r, l, unnest(regexp_extract_all(c, '{term}')) AS w,
    unnest(string_split_regex(c, '{term}')[1:len(regexp_extract_all(c, '{term}'))]) AS gap,
    unnest(range(len(regexp_extract_all(c, '{term}')))) AS i FROM parts),
located AS (
  SELECT r, lower(w) AS t, x AS a, x + length(w) AS b
  FROM (SELECT *, l + {place.format(by='r, l', v='w')} AS x FROM found)),
pairs AS (
  SELECT e, t, count(*) AS n_et FROM (SELECT DISTINCT r, t FROM located) JOIN shared USING (r) JOIN d USING (r)
  GROUP BY e, t HAVING count(DISTINCT text) >= {config.support}),
word AS (
  SELECT t, count(*) AS n_t FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '{term}'))) AS t FROM d)
  WHERE t IN (SELECT t FROM pairs) GROUP BY t),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM d),
over AS (
  SELECT e, t FROM pairs JOIN value USING (e) JOIN word USING (t), total
  WHERE n_e < n AND round(log2(n_et * n / (n_e * n_t)) / log2(n / n_e), 9) >= {config.generalise_share}),
spans AS (
  SELECT r, kind, name, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM base
  UNION ALL SELECT DISTINCT r, {len(KINDS)}, '{TERM}', CAST(a AS BIGINT), CAST(b AS BIGINT) 
    FROM located JOIN shared USING (r) JOIN over USING (e, t)),
joined AS (
  SELECT r, {counts},
    string_agg(name || ':' || a || ':' || b, ',' ORDER BY a, kind, b) FILTER (kind < {len(KINDS)}) AS of_base,
    string_agg(name || ':' || a || ':' || b, ',' ORDER BY a, kind, b) AS of_all FROM spans GROUP BY r)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in KINDS)},
  sha256(coalesce(of_base, '')) AS base_sha256, coalesce(of_all, '') AS spans
FROM d LEFT JOIN joined USING (r)"""


OP4_SQL = _oracle_sql()
