import hashlib
import random
import re

import duckdb

from sparkclassify.llm.pii import (KINDS, PiiConfig, _oracle_sql, find_personal_data, op4_personal_data,
                                   sanitise)

from . import cases

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base(text):
    out = []
    for rank, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind != "ip" or max(map(int, m.group().split("."))) <= 255,
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, m.end()))
    return sorted(out)


def expected(doc_id, text):
    spans = base(text)
    joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
    counts = tuple(sum(k == r for _, k, _ in spans) for r in range(4))
    return (doc_id, *counts, hashlib.sha256(joined.encode()).hexdigest(), joined)


def by_sql(df, config=PiiConfig()):
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    return sorted(con.execute(_oracle_sql(config)).fetchall())


AWKWARD = ["a@b.c@d.e", "a@b.c_x@d.e", "1.2.3.4.5.6.7.8", "1.2.3.256 0001.2.3.4", "+1 (377) 555-0271 x",
           "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "é\U0001f600x@y.z", "@@a@b.c..",
           "+123456789012345678", "9" * 3000, "a" * 50_000 + "@b.c", "x.y.z@" + "a." * 5000 + "b", "1..2@3.4.5.6"]


def test_base_spans_of_awkward_rows(spark):
    docs = cases.documents(spark, extra=[(100 + i, t, "en", "a") for i, t in enumerate(AWKWARD)])
    got = [tuple(r) for r in find_personal_data(docs).collect()]
    want = [expected(i, t) for i, t in docs.select("doc_id", "text").collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert find_personal_data(cases.empty(docs)).collect() == []


def test_given_documents(spark):
    from tests.conftest import SF_MEDIUM
    docs = spark.read.parquet(f"{SF_MEDIUM}/documents.parquet").select("doc_id", "text").collect()
    want = {i: expected(i, t) for i, t in docs}
    for r in op4_personal_data(spark, SF_MEDIUM).collect():
        spans = ",".join(s for s in r.spans.split(",") if not s.startswith("term:"))
        assert (*tuple(r)[:6], spans) == want[r.doc_id]
        assert r.spans == "" or spans


def test_disclosing_terms(spark):
    rng = random.Random(2)
    rows = [(i, cases.prose(rng, 30) + " common") for i in range(300)]
    for i in range(6):                              # always beside the value
        rows.append((1000 + i, f"common {cases.prose(rng, 3)} Zoltan wrote z.k@mail.example about common things"))
    for i in range(6):                              # beside it in a third of its documents
        rows.append((1100 + i, f"{cases.prose(rng, 4)} quartz"))
    for i in range(3):
        rows.append((1200 + i, f"quartz {cases.prose(rng, 2)} z.k@mail.example"))
    for i in range(9):                              # copies of one text are one witness
        rows.append((1300, "Umberto sent u@mail.example"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text, config = dict(rows), PiiConfig(generalise_share=0.6)
    found = {r.doc_id: [tuple(s.split(":")) for s in r.spans.split(",") if s] for r in find_personal_data(df, config=config).collect()}
    words = lambda i: {text[i][int(a):int(b)] for k, a, b in found[i] if k == "term"}
    assert all("Zoltan" in words(1000 + i) and "common" not in words(1000 + i) for i in range(6))
    assert all("quartz" in words(1200 + i) for i in range(3))
    assert found[1300] == [("email", "13", "27")]
    assert not any(found[i] for i in text if i < 1000 or 1100 <= i < 1200)
    assert by_sql(df, config) == sorted(tuple(r) for r in find_personal_data(df, config=config).collect())
    clean = {r.doc_id: r.text for r in sanitise(df, config=config).collect()}
    assert "Zoltan" not in clean[1000] and "[email]" in clean[1000] and "common" in clean[1000]
    assert "[term]" in clean[1200] and "quartz" not in clean[1200]
    assert all(clean[i] == text[i] for i in text if i < 1000 or 1100 <= i < 1200)
    none = find_personal_data(df, config=PiiConfig(support=100))
    assert not any("term" in r.spans for r in none.collect())


def test_terms_far_from_the_value(spark):
    rng = random.Random(5)
    far = lambda: " ".join("filler" for _ in range(60))
    rows = [(i, f"{cases.prose(rng, 20)} filler") for i in range(300)]
    for i in range(5):                              # beside the value, and again far from it
        rows.append((1000 + i, f"Zoltan z.k@mail.example {far()} {i} ZOLTAN, {far()} zoltan"))
    for i in range(5):                              # never near the value
        rows.append((1100 + i, f"Umberto {i} {far()} +1 (377) 555-0271"))
    for i in range(5):                              # near one value of two
        rows.append((1200 + i, f"q.r@mail.example {far()} {i} 10.1.2.3 Xanthippe"))
    for i in range(5):                              # near it twice, far from it as often as that
        rows.append((1300 + i, f"v.w@mail.example {far()} {i} quartz" if i else "v.w@mail.example quartz"))
    df = spark.createDataFrame(rows + [(2000, "Zoltan and Umberto")], "doc_id long, text string")
    text = dict(rows)
    named = {1000: "zoltan", 1100: "umberto", 1200: "xanthippe", 1300: "quartz"}
    for r in find_personal_data(df).collect():
        got = [s.split(":")[1:] for s in r.spans.split(",") if s.startswith("term:")]
        name = named.get(r.doc_id // 100 * 100, "none")
        want = [[str(m.start()), str(m.end())] for m in re.finditer(name, text.get(r.doc_id, "").lower())]
        assert got == want, (r.doc_id, r.spans)
    assert by_sql(df) == sorted(tuple(r) for r in find_personal_data(df).collect())
    clean = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert not any(re.search("zoltan|umberto|xanthippe|quartz", clean[i].lower()) for i in text if i >= 1000)
    assert clean[2000] == "Zoltan and Umberto" and all(clean[i] == text[i] for i in text if i < 1000)


def test_terms_that_touch_values(spark):
    """Words cut by a value, values that overlap, repeated rows and null text;
    the whole result equals the SQL."""
    rng = random.Random(9)
    rows = [(i, cases.prose(rng, 12)) for i in range(200)] + [(200, None), (201, "")]
    for i in range(5):
        rows.append((300 + i, f"{i} Z\u00f6lt\u00e1n\u00e9x.y@mail.example\u00c9gide +4111 1111 1111 1111 Brunhilde {i}"))
        rows.append((400 + i, f"{i} \U0001f600 Zoltan 10.1.2.3+1 (377) 555-0271Ottokar"))
    df = spark.createDataFrame(rows + rows[-6:], "doc_id long, text string")
    got = sorted(tuple(r) for r in find_personal_data(df).collect())
    assert got == by_sql(df)
    text = dict(rows)
    terms = {i: {text[i][int(a):int(b)].lower() for k, a, b in (s.split(":") for s in spans.split(",") if s) if k == "term"}
             for i, *_, spans in got}
    assert all(terms[300 + i] == {"brunhilde"} and {"zoltan", "ottokar"} <= terms[400 + i] for i in range(5))


def test_sanitise_keeps_columns(spark):
    docs = cases.documents(spark)
    out = sanitise(docs)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    key = lambda r: str(tuple(r))
    want = [r.asDict() | {"text": "write to [email] now"} if r.doc_id == 15 else r.asDict() for r in docs.collect()]
    assert sorted(map(str, (r.asDict() for r in out.collect()))) == sorted(map(str, want)), key
