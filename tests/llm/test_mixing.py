"""Poisson replication against plain inversion."""

import hashlib
import math
from collections import Counter

import pytest

from placetime.llm import mixing


def plain_times(doc_id, text, rate, seed=mixing.SEED):
    key = hashlib.md5(f"{'' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()
    parts, total = max(1, math.ceil(rate / 400)), 0
    for part in range(1, parts + 1):
        u = (int(hashlib.md5(f"{key}:{seed}:{part}:u".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        p = upto = math.exp(-rate / parts)
        k = 0
        while upto < u:
            k += 1
            p *= rate / parts / k
            upto += p
        total += k
    return total


def plain_rates(rows, flatness=mixing.FLATNESS):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += max(1, len(text or ""))
    weights = {s: n ** flatness for s, n in sizes.items()}
    whole = sum(sizes.values())
    return {s: weights[s] / sum(weights.values()) * whole / n for s, n in sizes.items()}


ROWS = [(i, "t" * (i % 50 + 1), "big" if i % 4 else "small") for i in range(300)] + [(None, "x", None), (None, None, None), (5, "", "small"), (5, "", "small"), (1000, "long " * 20_000, "long")]


def test_rows_against_plain_inversion(spark):
    docs = spark.createDataFrame([(*r, 1, 2) for r in ROWS], "doc_id long, text string, source string, copies int, digest int")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    rates, want = plain_rates(ROWS), Counter()
    for doc_id, text, source in ROWS:
        want[doc_id, text, source] += plain_times(doc_id, text, rates[source])
    assert Counter((r.doc_id, r.text, r.source) for r in out.collect()) == +want
    assert sorted(map(str, mixing.mixed(docs).collect())) == sorted(map(str, out.collect()))


def test_given_weights(spark):
    docs = spark.createDataFrame([(i, "abcd", "a" if i % 3 else "b") for i in range(3000)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 1.0), ("none", 5.0), ("b", 3.0)], "source string, weight double")
    found = Counter(r.source for r in mixing.mixed(docs, weights).collect())
    assert found["a"] == pytest.approx(750, abs=90) and found["b"] == pytest.approx(2250, abs=150)
    only = mixing.mixed(docs, weights.where("source = 'b'"), total=12_000.0)
    assert {r.source for r in only.collect()} == {"b"} and only.count() == pytest.approx(3000, abs=200)


def test_large_rates_are_sums(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    n = mixing.mixed(docs, total=900.0).count()
    assert n == plain_times(1, "a", 900.0) and abs(n - 900) < 150


def test_empty_table_and_native_plan(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mixed(docs).collect() == []
    assert "Python" not in mixing.mixed(docs)._jdf.queryExecution().toString()
