"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from placetime.llm import variants


def plain_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain(words):
    close = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if one_apart(a, b):
            close[a].append(b)
            close[b].append(a)
    form = {}
    for w, others in close.items():
        top = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = top if top and words[top] >= 5 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n, len(close[w]), form[w], words.get(form[w]), root))
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abé", k=rng.randint(5, 8))) for _ in range(300)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "ÀÉßabcd"]
    texts = [" ".join(w for w in rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=300)) for _ in range(60)]
    odd = [(None, "Gesundheit, gesundheit! GESUNDHEIT-gesundheit gesundheit1gesundheit"), (None, None), (7, ""), (8, " \n"), (9, "x" * 50_000 + " y"), (9, "straße " * 7 + "strasse " * 40 + "strase " * 9), (10, "kettea " * 6 + "ketteb " * 35 + "kettebc " * 180)]
    return [(i, t) for i, t in enumerate(texts)] * 2 + odd


@pytest.mark.parametrize("crowd", [2, 64])
def test_against_all_pairs(spark, crowd):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "w", 5) for r in rows], "doc_id long, text string, word string, n int").repartition(6)
    got = variants.variants(docs, crowd).collect()
    want = plain(plain_words(rows))
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(r[2] > 5 for r in want) and any(r[3] not in (None, r[5]) for r in want)


def test_pairs_come_once(spark):
    words = ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aabaaa", "baaaaa", "aaaaab", "abaaaaa", "zzzzzz", "zzzzzzé"] + [f"prefix{a}{b}suffix" for a in "abcdefghij" for b in "abcdefghij"]
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    for crowd in (1, 3, 1000):
        got = [tuple(sorted((r.u, r.v))) for r in variants.near_pairs(table, crowd).collect()]
        assert sorted(got) == sorted(tuple(sorted(p)) for p in combinations(words, 2) if one_apart(*p))


def test_no_key_stays_crowded(spark):
    words = spark.createDataFrame([("start" + "".join(random.Random(i).choices("abcdefgh", k=6)), 5) for i in range(3000)], "word string, n long").distinct()
    lists = variants.dealt(words, 50)
    assert lists.where("j - i > 1").groupBy("key").count().agg({"count": "max"}).first()[0] <= 50


@pytest.mark.parametrize("seed", range(5))
def test_sorted_list_scan(seed):
    rng = random.Random(seed)
    entries = sorted({"".join(rng.choices("ab", k=rng.randint(0, 6))) for _ in range(60)})
    lcps = [0, *(variants.shared(a, b) for a, b in zip(entries, entries[1:], strict=False))]
    for word in entries:
        got = {entries[k] for k in variants.near(word, entries, lcps)}
        assert got == {e for e in entries if e == word or one_apart(e, word)}


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(100)], "word string, form string")
    assert {r.root for r in variants.roots(forms).collect()} == {"w100"}


def test_empty_and_all_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert variants.variants(docs.where("false")).collect() == []
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {tuple(r) for r in variants.variants(docs).collect()} == plain(plain_words(rows))
