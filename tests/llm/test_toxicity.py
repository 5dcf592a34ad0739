"""The machine against a plain sum over pairs, and held-out accuracy."""

import math
import random
import zlib

import numpy as np
import pytest

from placetime.llm import toxicity


def plain_score(model, text):
    at = sorted({model.known[t] for t in toxicity.terms(text).tolist() if t in model.known})
    raw = model.bias + sum(model.weights[i] for i in at)
    raw += sum(float(model.factors[i] @ model.factors[j]) for a, i in enumerate(at) for j in at[:a])
    return 1 / (1 + math.exp(-raw))


def pair_texts(n, seed):
    """Toxic only where an insult meets a mention of a group."""
    chance, out = random.Random(seed), []
    for _ in range(n):
        words = [f"w{chance.choice('abcdefgh')}{chance.choice('xyz')}q" for _ in range(20)]
        insult, group = chance.random() < 0.5, chance.random() < 0.5
        out.append((" ".join(words + ["foolish"] * insult + ["people"] * group), int(insult and group)))
    return out


def test_pairs_are_learned():
    rows = pair_texts(1500, 1)
    model = toxicity.fit([toxicity.terms(t) for t, _ in rows], np.array([y for _, y in rows], float), 1 / 3)
    new = pair_texts(300, 2)
    assert sum((model.score(t) >= 0.5) == y for t, y in new) >= 297
    for text, _ in new[:50]:
        assert model.score(text) == pytest.approx(plain_score(model, text), abs=1e-9)
    weights = [model.weights[model.known[zlib.crc32(w)]] for w in (b"foolish", b"people")]
    assert model.bias + max(weights) < 0, "neither word alone is enough"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.scored(docs, labels)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert got.count() == docs.count()
    yes = [r.predicted for r in rows if r.toxic == 1]
    no = [r.predicted for r in rows if r.toxic == 0]
    # one toxic label in ten is noise here: English texts without any insult
    assert sum(yes) >= 0.82 * len(yes) and sum(no) <= 0.01 * len(no), (sum(yes), len(yes), sum(no), len(no))
    for r in got.limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, f"fine words {i} here" if i % 2 else "awful rubbish text", "x") for i in range(200)] + [(None, "awful rubbish", "x"), (300, None, "x"), (300, "", "x"), (301, "fine " * 60_000, "x"), (301, "fine " * 60_000, "x")], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(200)] + [(0, 0), (None, 1), (1, None)], "doc_id long, toxic int")
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == 205
    for r in got:
        if r.doc_id is not None and r.doc_id < 200:
            assert r.predicted == int(r.doc_id % 2 == 0)
    empty = {r.score for r in got if r.doc_id == 300}
    assert len(empty) == 1 and [r.held_out for r in got if r.doc_id is None] == [True]
    none = toxicity.scored(docs, labels.where("toxic = 1")).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.scored(docs.limit(0), labels).collect() == []


def test_scores_do_not_use_labels_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic")
    key = lambda df: sorted((r.doc_id, r.score) for r in df.collect())
    assert key(toxicity.scored(docs, labels)) == key(toxicity.scored(docs, turned))
