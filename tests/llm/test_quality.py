"""Quality rules against plain loops."""

import re
from collections import Counter

import pytest

from placetime.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(lines))


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e f g h", "a b c d e f g h " * 3, "x " * 40, "a|b <c> ##\n\n a|b <c> ##\nz",
    "é ß\xa0ü x\n" * 5, " ".join(map(str, range(30))) + " " + " ".join(map(str, range(5, 20))),
    "w " * 5_000 + "end", "z" * 100_000, "p q\n" * 3_000,
]


def test_counts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = {r.i: tuple(r.c) for r in df.select("i", quality.counts("text").alias("c")).collect()}
    assert got == {i: plain_counts(t) for i, t in enumerate(TEXTS)}


def bin_of(v):
    width = max(v.bit_length() - 7, 0)
    return v >> width << width


def test_sketch_bins_and_quantiles(spark):
    values = [0, 1, 15, 16, 17, 18, 100, 1000, 999_999]
    rows = [("en", "s", [v]) for v in values]
    counters = quality.sketches(spark.createDataFrame(rows, "lang string, source string, measures array<long>"))
    assert {(r.bin, r.n) for r in counters.collect()} == set(Counter(map(bin_of, values)).items())
    q = quality.quantiles(counters, "lang", "source").first()
    assert (q.total, q.median, q.high) == (9, bin_of(17), bin_of(100))
    twice = quality.merged(counters.union(counters), "lang")
    assert quality.quantiles(twice, "lang").first().median == bin_of(17)


def test_limits_follow_the_source(spark):
    clean = " ".join(f"word{i}" for i in range(40))
    noisy = clean + " ##"
    rows = [(i, noisy if i % 10 else noisy + "#" * 200, "en", "code", "x") for i in range(300)] + [(1000 + i, clean if i else noisy + "#" * 20, "en", "news", "y") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, counted string")
    kept = {r.doc_id for r in quality.judged(docs).collect() if r.kept}
    assert kept == {i for i in range(300) if i % 10} | set(range(1001, 1300))
    left = quality.passing(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == kept


def test_sources_of_different_spread_have_different_limits(spark):
    """Every limit of the wide source is above that of the narrow one, and none is the least distance."""
    rows = [("en", s, [k * (i % 100) // 10 + 100 for k in (1, 2, 3, 4)] if s == "wide" else [k * (i % 100) // 30 + 100 for k in (4, 8, 8, 3)]) for i in range(1000) for s in ("wide", "narrow")]
    tops = {r.source: r.limits for r in quality.limits(spark.createDataFrame(rows, "lang string, source string, measures array<long>")).collect()}
    def plain(values, rule):
        per_cent, factor, least = rule
        ranked = sorted(map(bin_of, values))
        median, high = (ranked[-(-p * len(ranked) // 100) - 1] for p in (50, per_cent))
        return max(high + (high - median) * factor // 10, median + least)
    for s in tops:
        of = list(zip(*(m for _, name, m in rows if name == s), strict=True))
        assert tops[s] == [plain(v, r) for v, r in zip(of, quality.RULES.values(), strict=True)]
    assert all(a != b for a, b in zip(tops["wide"], tops["narrow"], strict=True))


@pytest.mark.parametrize("least", [1, 5, 200])
def test_odd_rows(spark, least):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(1, text, None, None), (1, text, None, None), (None, None, "en", "a"), (2, "", None, "a"), (3, text + " ####" * 50, "en", None), (4, text, "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = sorted(((r.doc_id, r.base_failed, r.kept) for r in quality.judged(docs, least).collect()), key=str)
    assert [(g[0], g[1]) for g in got] == sorted([(1, False), (1, False), (None, True), (2, True), (3, True), (4, False)], key=str)
    assert sum(g[2] for g in got) == quality.passing(docs, least).count()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality.judged(docs).collect() == [] and quality.passing(docs).collect() == []


def test_no_python_in_the_plan(spark, sf):
    plan = quality.judged(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality.judged(docs).join(labels, "doc_id").where("not base_failed").select("quality", "kept").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.995 * len(good) and sum(bad) <= 0.1 * len(bad)
