"""Digests against plain loops over windows."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from placetime.llm import digest


def plain_bin(window):
    total = sum(round(c * math.log2(c) * (1 << 20)) for c in Counter(window).values())
    top = 64 * 6 * (1 << 20)
    return (top - total) * 1023 // top


@pytest.mark.parametrize("seed", range(4))
def test_entropies(seed):
    chance = random.Random(seed)
    data = bytes(chance.choice(b"abcdefgh \xc3\xa9" if seed else b"ab") for _ in range(900))
    assert digest.entropies(np.frombuffer(data, np.uint8)).tolist() == [plain_bin(data[i:i + 64]) for i in range(len(data) - 63)]


def plain_places(text, rank):
    r = [int(rank[plain_bin(text[i:i + 64])]) for i in range(len(text) - 63)]
    return [i for i, v in enumerate(r) if all(v < x for x in r[max(0, i - 32):i]) and all(v <= x for x in r[i + 1:i + 33])]


def test_features_stand_alone():
    chance = random.Random(1)
    texts = [bytes(chance.choice(b"the quick brown fox \n") for _ in range(n)) for n in (500, 64, 63, 0, 1, 2000, 65)] + [b"z" * 300]
    rank = digest.ranks(digest.histogram(texts))
    together = digest.features(texts, rank)
    for text, (at, marks) in zip(texts, together):
        alone = digest.features([text], rank)[0]
        assert at.tolist() == alone[0].tolist() and marks.tolist() == alone[1].tolist()
        if len(text) >= 64:
            assert at.tolist() == plain_places(text, rank) and len(at) > 0
        else:
            assert len(at) == min(1, len(text))


def test_edited_digest_equals_that_of_the_edited_text():
    chance = random.Random(2)
    word = lambda: "".join(chance.choice("abcdeéß") for _ in range(chance.randrange(1, 9)))
    texts = [" ".join(word() for _ in range(n)) for n in (0, 1, 5, 12, 30, 60, 200, 900, 3, 400)]
    rank = digest.ranks(digest.histogram([t.encode() for t in texts]))
    pairs = list(zip(texts, [*texts[1:], texts[0]]))
    for (text, following), (n, sha, fp, efp, near, nxt) in zip(pairs, digest.digests(pairs, rank)):
        k = len(text) // 4
        other = text[:len(text) - k] + following[:k]
        chains = [digest.chain(digest.features([t.encode()], rank)[0][1]) for t in (text, other, following)]
        assert (n, sha, fp, efp) == (len(text), hashlib.sha256(other.encode()).hexdigest(), chains[0].tobytes().hex(), chains[1].tobytes().hex())
        assert near == digest.likeness(chains[0], chains[1]) and nxt == digest.likeness(chains[0], chains[2])


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = {r.doc_id: r for r in digest.fingerprints(docs).collect()}
    assert len(got) == len(rows)
    same = {}
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        k = len(text) // 4
        other = text[:len(text) - k] + following[:k]
        assert got[i].edited_sha256 == hashlib.sha256(other.encode()).hexdigest() and got[i].n_chars == len(text)
        assert same.setdefault(text, got[i].fingerprint) == got[i].fingerprint
        assert same.setdefault(other, got[i].edited_fingerprint) == got[i].edited_fingerprint
    near = sorted(r.near_edited for r in got.values() if r.n_chars > 300)
    apart = sorted(got[i].near_next for (i, t), (_, f) in zip(rows, rows[1:]) if len(t) > 300 and t[:50] != f[:50])
    assert near[len(near) // 10] > 0.5 and apart[9 * len(apart) // 10] < 0.1


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_order_over_ranges(spark, ranges):
    ids = [5, 1, 9, 9, 3, 1_000_000, -4, 7]
    docs = spark.createDataFrame([(i, f"{n}") for n, i in enumerate(ids)], "doc_id long, text string")
    parts = digest.in_order(docs, ranges).rdd.glom().collect()
    found = {}
    for part in parts:
        for a, b in zip(part, part[1:]):
            if a.range == b.range and not a.after:
                found[(a.doc_id, a.text)] = (b.doc_id, b.text)
    order = sorted(zip(ids, map(str, range(len(ids)))))
    assert found == dict(zip(order, order[1:] + order[:1]))


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "a", "x"), (None, "abcd" * 40, "x"), (3, "k" * 120_000, "x"), (4, "abcd", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, range string")
    got = sorted(((r.doc_id, r.n_chars, r.near_edited, r.near_next, r.fingerprint == "") for r in digest.fingerprints(docs).collect()), key=str)
    assert [(g[0], g[1], g[4]) for g in got] == sorted([(1, 0, True), (2, 0, True), (2, 1, False), (None, 160, False), (3, 120_000, False), (4, 4, False)], key=str)
    assert {g[0]: g[3] for g in got}[None] == 0 and {g[0]: g[3] for g in got}[1] == 1
    one = digest.fingerprints(docs.where("doc_id = 4")).collect()[0]
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"abca").hexdigest()
    assert digest.fingerprints(docs.limit(0)).collect() == []
