"""The network against plain loops, and what it learns."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from placetime.llm import lm


def toy(n, seed):
    chance = random.Random(seed)
    return [" ".join(w for _ in range(chance.randrange(5, 12)) for w in chance.choice([("red", "fox"), ("blue", "sky"), ("old", "tree")])) for _ in range(n)]


def plain_score(net, ids):
    w, total, n = net.weights, 0.0, lm.IDS // lm.CLUSTERS
    for t, target in enumerate(ids):
        h = w["bias"].astype(float)
        for j, step in enumerate(lm.SIDE):
            h = h + w["inner"][j][ids[t + step] if 0 <= t + step < len(ids) else lm.EDGE]
        h = np.tanh(h)
        c, i = divmod(int(net.place[target]), n)
        for logits, at in ((h @ w["cluster"] + w["cluster_bias"], c), (h @ w["within"][c] + w["within_bias"][c], i)):
            total += logits[at] - math.log(np.exp(logits - logits.max()).sum()) - logits.max()
    return total


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(list(enumerate(toy(8000, 1))), "doc_id long, text string").repartition(3).cache()


@pytest.fixture(scope="module")
def model(corpus):
    words = lm.vocabulary(corpus)
    return words, lm.trained(lm.coded(corpus, words), words)


def test_scores_against_plain_loops(spark, corpus, model):
    words, net = model
    texts = {r.doc_id: r.text for r in corpus.collect()}
    for r in lm.scored(corpus).limit(30).collect():
        ids = words.ids(texts[r.doc_id])
        assert r.n_words == len(ids) and r.score == pytest.approx(plain_score(net, ids), rel=1e-4)
        assert r.per_word == pytest.approx(r.score / len(ids))


def test_context_is_learned_from_both_sides(model):
    words, net = model
    blank, long = lm.Network.start(words.counts), lm.Network.start(words.counts)
    new = net.windows([words.ids(t) for t in toy(50, 3)])
    assert net.log_probabilities(*new).mean() > blank.log_probabilities(*new).mean() + 0.1
    target, around = net.windows([words.ids(t) for t in toy(400, 4)])
    for _ in range(80):
        long.learn(target, around)
    chance = random.Random(5)
    better = 0
    for text in toy(40, 2):
        mixed = text.split()
        chance.shuffle(mixed)
        score = lambda t: long.log_probabilities(*net.windows([words.ids(t)])).mean()
        better += score(text) > score(" ".join(mixed)) + 0.3
    assert better >= 38


def test_counts(spark):
    docs = spark.createDataFrame([("a b a",), ("b c\n a",), (None,), ("",)], "text string")
    assert {r.word: r.n for r in lm.word_counts(docs).collect()} == {"a": 3, "b": 2, "c": 1}
    words = lm.vocabulary(docs)
    assert words.words == ("a", "b", "c") and words.counts.sum() == 6 and words.known.tolist() == [3, 2, 1]
    assert words.ids("zz a").tolist() == [lm.shared_id("zz"), 1 + lm.SHARED]


def test_gradient(model):
    words, net = model
    target, around = net.windows([words.ids(t) for t in toy(4, 9)])
    copy = lm.Network({k: v.copy() for k, v in net.weights.items()}, net.place)
    before = copy.log_probabilities(target, around).mean()
    for _ in range(20):
        copy.learn(target, around)
    assert copy.log_probabilities(target, around).mean() > before


def test_odd_rows(spark):
    rows = [(1, None, 1), (1, None, 1), (None, "", 2), (2, "a b", 3), (2, "a b", 3), (3, "w " * 50_000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    got = lm.scored(docs).collect()
    assert sorted(r.n_words for r in got) == [0, 0, 0, 2, 2, 50_000]
    assert all(r.score == 0 for r in got if r.n_words == 0) and all(r.score < 0 for r in got if r.n_words)
    assert [r.score for r in lm.scored(docs.where("text is null")).collect()] == [0.0, 0.0]
    assert lm.scored(docs.limit(0)).collect() == []


@pytest.mark.parametrize("known", [lm.IDS - lm.SHARED, lm.KNOWN])
def test_words_that_share_an_id_are_told_apart(spark, monkeypatch, known):
    """Both by the counts that every task has and by the join."""
    monkeypatch.setattr(lm, "KNOWN", known)
    common = [(i, " ".join(f"w{k}" for k in range(lm.IDS) for _ in range(2))) for i in range(3)]
    rows = [*common, (10, "rare rare rare bare"), (11, "bare"), (12, "rare"), (12, "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = lm.vocabulary(docs)
    assert not {"rare", "bare"} & set(words.words[:lm.IDS - 1 - lm.SHARED]) and lm.shared_id("rare") == lm.shared_id("bare")
    got = {r.doc_id: r for r in lm.scored(docs).collect()}
    # five and two of the words with this id; all else is alike
    assert got[12].score - got[11].score == pytest.approx(math.log(5 / 2), rel=1e-6)
    assert got[12].per_word == got[12].score and lm.scored(docs).count() == len(rows)


def test_real_documents_with_rare_words(spark, sf, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", 2000)  # so that known, shared and joined words all occur
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").cache()
    texts = {r.doc_id: r.text for r in docs.collect()}
    counted = {r.word: r.n for r in lm.word_counts(docs).collect()}
    words = lm.vocabulary(docs)
    net = lm.trained(lm.coded(docs, words), words)
    own = set(words.words[:lm.IDS - 1 - lm.SHARED])
    assert len(counted) > 4000 and lm.IDS < len(words.words) <= 2000
    got = {r.doc_id: r for r in lm.scored(docs).collect()}
    for doc_id in sorted(texts)[:15]:
        split = texts[doc_id].split()
        parts = sum(math.log(counted[w] / words.counts[lm.shared_id(w)]) for w in split if w not in own)
        assert got[doc_id].score == pytest.approx(plain_score(net, words.ids(texts[doc_id])) + parts, rel=1e-4)


def _small():
    rng = np.random.default_rng(5)
    net = lm.Network.start(rng.integers(0, 1000, lm.IDS))
    ids = [rng.integers(0, lm.IDS, n).astype(np.int16) for n in (1, 0, 700, 1300)]
    return net, *net.windows(ids)


def _plain(net, target, around, at):
    """Log probability of one word by the definition, in double precision."""
    w = {k: v.astype(float) for k, v in net.weights.items()}
    size = lm.IDS // lm.CLUSTERS
    c, i = divmod(int(net.place[target[at]]), size)
    h = np.tanh(w["bias"] + sum(w["inner"][j][around[j, at]] for j in range(len(lm.SIDE))))
    share = lambda x, k: x[k] - np.log(np.exp(x).sum())
    return share(h @ w["cluster"] + w["cluster_bias"], c) + share(h @ w["within"][c] + w["within_bias"][c], i)


def test_probabilities_and_slopes_follow_the_definition():
    net, target, around = _small()
    for _ in range(2):
        got = net.log_probabilities(target, around)
        assert got[::97] == pytest.approx([_plain(net, target, around, at) for at in range(0, len(target), 97)], abs=1e-4)
        net.learn(target, around)
    start, target, around = _small()
    one = lm.Network({k: v.copy() for k, v in start.weights.items()}, start.place)
    one.learn(target, around)
    for k, spot in (("inner", (1, int(around[1, 0]), 3)), ("bias", (2,)), ("cluster", (4, 5)), ("cluster_bias", (0,)), ("within", (0, 1, 2)), ("within_bias", (0, 3))):
        moved = {}
        for step in (-1e-3, 1e-3):
            start.weights[k][spot] += np.float32(step)
            moved[step] = float(np.mean([_plain(start, target, around, at) for at in range(len(target))]))
            start.weights[k][spot] -= np.float32(step)
        slope = (moved[-1e-3] - moved[1e-3]) / 2e-3
        went = float(one.weights[k][spot] - start.weights[k][spot])
        assert went == pytest.approx(-lm.RATE * slope / np.sqrt(1e-2 + slope * slope), rel=0.05, abs=1e-4), k


def test_learning_takes_no_logarithms_and_one_gather_of_all_sides(monkeypatch):
    net, target, around = _small()
    called = Counter()
    for name in ("log", "argsort"):
        monkeypatch.setattr(lm.np, name, lambda *a, _f=getattr(np, name), _n=name, **k: (called.update([_n]), _f(*a, **k))[1])
    net.learn(target, around)
    assert called == {"argsort": 2}
