import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placetime.functions import text


def test_rewrite_rounds(one):
    rules = {"X": "F-[[X]+X]+F[+FX]-X", "F": "FF"}
    texts = [one(text.rewrite("s", rules, n), s="X") for n in (1, 2, 3)]
    assert texts[0] == rules["X"]
    assert [len(t) for t in texts] == [18, 89, 379]


def test_rewrite_is_simultaneous_and_survives_stand_ins(one):
    rules = {"a": "b", "b": "a"}
    assert one(text.rewrite("s", rules), s="abba") == "baab"
    assert one(text.rewrite("s", rules), s="ab") == "ba"
    assert one(text.rewrite("s", {"": "x", "a": ""}), s="a") == "x"
    with pytest.raises(Exception, match="grows more than"):
        one(text.rewrite("s", {"a": "aaaaaaaaaa"}, rounds=6), s="a")
    # the text decides, not the rules alone
    assert one(text.rewrite("s", {"a": "aaaaaaaaaa"}, rounds=6), s="bcd") == "bcd"
    first = "\ue000\ue001a\ue002"
    assert one(text.rewrite("s", {"a": "\ue003x"}), s=first) == "\ue000\ue001\ue003x\ue002"


def test_tokens(one):
    assert one(text.extract_tokens("s"), s="F-[[X]+12+3-RL|") == ["F", "-", "[", "[", "]", "+", "12+", "3-", "R", "L", "|"]


def reference_split(value, sep, esc):
    parts, now, escaped = [], "", False
    for ch in value:
        if escaped:
            now, escaped = now + ch, False
        elif ch == sep:
            parts.append(now)
            now = ""
        elif ch == esc:
            escaped = True
        else:
            now += ch
    return parts + [now] if now else parts


def test_split_escaped_agrees_with_a_character_walk(spark):
    samples = ["", ",", "a", "a,b", "a,b,", "a,,b", "a\\,b,c", "a\\\\,b", "\\", "a\\", "a,\\", ",,", "\\,,", "a\nb,c\\\n,d", "x\\yz"]
    import itertools

    samples += ["".join(p) for n in range(1, 6) for p in itertools.product("a,\\", repeat=n)]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    for row in df.select("s", text.split_escaped("s", ",", "\\").alias("p")).collect():
        assert row.p == reference_split(row.s, ",", "\\"), row.s
    long = "x" * 50_000 + ",y"
    got = spark.createDataFrame([(long,)], "s string").select(text.split_escaped("s", ",", "\\")).first()[0]
    assert got == ["x" * 50_000, "y"]


def test_links(one):
    assert one(text.link_page("s"), s="a.html#b") == "a.html"
    assert one(text.link_is_page("s"), s="a.html") is True
    assert one(text.link_is_page("s"), s="a.html#") is False
    add = text.add_parameter("s", "q", F.lit("x y"))
    assert one(add, s="a.html#b") == "a.html?q=x y#b"
    assert one(add, s="a?z=1") == "a?z=1&q=x y"
    assert one(add, s="?z=1") == "?z=1?q=x y"
    assert one(text.path_of("s"), s="https://h.example.com/en/25?x#y") == "en/25"
    assert one(text.shared_prefix("p", "l"), p="en/25/a", l="en/25/index.html") == 2
    assert one(text.shared_prefix("p", "l"), p="en/25", l="english/25") == 0


def test_mark_and_unmark(one):
    assert one(text.mark_all("s", F.lit("a.b")), s="xA.B aab a.b") == "x<mark>A.B</mark> aab <mark>a.b</mark>"
    assert one(text.mark_all("s", F.lit("")), s="abc") == "abc"
    assert one(text.mark_all("s", F.lit("é")), s="É") == "<mark>É</mark>"
    assert one(text.unmark("s", F.lit("a+")), s="<mark>A+</mark> <mark>b</mark>") == "A+ <mark>b</mark>"
    assert one(text.mark_all("s", F.lit("$1\\E")), s="x$1\\Ey") == "x<mark>$1\\E</mark>y"


def plain_snippet(value, query):
    at = value.lower().find(query.lower())
    if at < 0:
        return value
    marked = value[:at] + text.MARK_OPEN + value[at:at + len(query)] + text.MARK_CLOSE + value[at + len(query):]
    begin = 0 if at < 50 else max(value[:at].rfind(c) for c in " ,:") + 1
    stop = begin + 234
    if stop >= len(marked):
        return marked[begin:]
    ends = [i for i in (marked.find(c, stop) for c in " ,:") if i >= 0]
    return marked[begin:min(ends)] + "…" if ends else marked[begin:]


def test_snippet_known_cases(one):
    cut = text.snippet("s", F.lit("Hit"))
    assert one(cut, s="a hit b") == "a <mark class='search-match'>hit</mark> b"
    assert one(cut, s="nothing") == "nothing"
    early = "hit " + "word " * 100
    assert one(cut, s=early) == plain_snippet(early, "hit")
    assert one(cut, s=early).endswith("…")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab ,:é", max_size=600), min_size=8, max_size=8))
def test_snippet_agrees_with_a_plain_version(spark, values):
    df = spark.createDataFrame([(v + "Qx" + v[::-1],) for v in values], "s string")
    for row in df.select("s", text.snippet("s", F.lit("qX")).alias("t")).collect():
        assert row.t == plain_snippet(row.s, "qx")
        assert len(re.findall("<mark", row.t)) == 1
