"""Personal data against plain patterns and loops."""

import hashlib
import re

from placetime.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def line_of(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


TEXTS = [
    None, "", "é ß a@b.c_d@e.f.g x@y, @z.q", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.004 999999999999.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111-2",
    "+1 (771) 555-1655 On. +49 30 1234567 +1+2 3333333333", "\U0001f600 a.b@c.de \U0001f600 10.0.0.1", "9" * 30_000, "a" * 100_000 + "@b.cc", "a." * 40_000, "1 " * 20_000, "+1" + "(" * 30_000,
    "x@y.z " * 800, "1.1.1.1 " * 500 + "end", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" x", "mail me: joe.05@mail3.example.com!!", "a@b" * 3000, "0 0 0 0 0 0 0 0 0 0 0 0 0 0",
]


def test_base_spans(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.detected(df).collect()}
    for i, t in enumerate(TEXTS):
        want = plain_base(t)
        assert got[i].base_sha256 == hashlib.sha256(line_of(want).encode()).hexdigest(), (i, line_of(want)[:200], got[i].spans[:200])
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(x[1] == k for x in want) for k in range(4)]
        own = [s for s in got[i].spans.split(",") if s.split(":")[0] in pii.BASE]
        assert ",".join(own) == line_of(want)


def test_documents(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = pii.detected(docs).collect()
    assert len(got) == len(rows)
    added = []
    for r in got:
        want = plain_base(rows[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(line_of(want).encode()).hexdigest()
        spans = [s.split(":") for s in r.spans.split(",") if s]
        starts = [(int(s[1]), pii.KINDS.index(s[0])) for s in spans]
        assert starts == sorted(starts)
        added += [rows[r.doc_id][int(a):int(b)] for k, a, b in spans if k in pii.ADDED]
    cards = [t for t in added if re.fullmatch("[0-9]{16}", t)]
    keys = [t for t in added if re.fullmatch("[0-9a-f]{40}", t)]
    assert cards and keys


def test_votes_tell_good_labellers_from_bad():
    counts = {"11": 60, "1-": 20, "00": 100, "0-": 20, "10": 2, "01": 30}
    prior, reliability, post = pii.expectation_maximisation(counts)
    assert post["11"] > 0.9 and post["00"] < 0.1 and 0.2 < prior < 0.8
    first, second = reliability
    assert first[0]["1"] > 0.5 > first[1]["1"] and second[0]["1"] > second[1]["1"]


def test_redaction(spark):
    rows = [(1, "mail a@b.cc, ip 1.2.3.4.", 24, "f"), (1, "mail a@b.cc, ip 1.2.3.4.", 24, "f"), (None, None, None, "f"), (2, "", 0, "f"), (3, "é clean text", None, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, found string")
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    got = sorted((tuple(r) for r in out.collect()), key=str)
    want = "mail [EMAIL], ip [IP]."
    assert got == sorted([(1, want, len(want), "f"), (1, want, len(want), "f"), (None, None, None, "f"), (2, "", 0, "f"), (3, "é clean text", None, "f")], key=str)


def test_overlapping_spans_are_one_gap(spark):
    df = spark.createDataFrame([("ab 123456 cd", [(3, 2, 7), (5, 3, 9)])], "text string, spans array<struct<s:int,k:int,e:int>>")
    assert df.select(pii.without(df.text, df.spans)).first()[0] == "ab [CARD] cd"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.detected(docs).collect() == [] and pii.redacted(docs).collect() == []


def test_no_python_in_the_plan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = pii.redacted(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
