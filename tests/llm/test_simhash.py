"""SimHash against plain loops."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from placetime.llm import simhash
from placetime.llm.components import components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, budget=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return {(d, least.get(find(i))) for i, d in enumerate(ids)}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one Two", "ÄÖ éÀ Z b\xa0c d e", "a b c d e f g h " * 40])
def test_fingerprint(text):
    assert simhash.simhash(text) & (2**64 - 1) == plain_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(str(i) for i in range(500))
    want = simhash.simhash(text)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.simhash(text) == want


def test_spark_hash_is_the_same(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b ç"))).first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest("a b ç".encode(), 42)


@pytest.mark.parametrize("leaf", [8, 100_000])
def test_links_find_all_groups(spark, leaf):
    chance = random.Random(leaf)
    fps = {chance.getrandbits(64) for _ in range(150)}
    for f in list(fps)[:60]:
        for _ in range(4):
            f ^= 1 << chance.randrange(64)
            fps.add(f)
    crowd = chance.getrandbits(64)
    fps |= {crowd ^ (1 << a) ^ (1 << b) for a in range(0, 64, 9) for b in range(64)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(df, leaf=leaf)
    assert edges.count() <= 60 * len(fps)
    roots = {r.node: r.root for r in components(edges).collect()}
    got = {}
    for s, f in zip(signed, fps):
        got.setdefault(roots.get(s, s), set()).add(f)
    want = {}
    for f, r in plain_components(fps, fps):
        want.setdefault(r, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_documents_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    got = simhash.groups(docs).select("doc_id", simhash.as_hex("fp"), "component_id").collect()
    assert {(r[0], r[2]) for r in got} == plain_components([r.doc_id for r in rows], fps)
    assert {(r[0], r[1]) for r in got} == {(r.doc_id, f"{f:016x}") for r, f in zip(rows, fps)}


def test_odd_rows(spark):
    long = "x " * 30_000 + "y" * 100_000
    rows = [(3, "a b c d", 1), (1, "A b  c\td", 2), (1, "A b  c\td", 2), (5, None, 3), (4, "", 4), (None, "q r s t", 5), (None, "a b c d", 6), (9, long, 7), (8, long, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, content long")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.groups(docs).collect()), key=str)
    assert got == sorted([(3, 1), (1, 1), (1, 1), (5, 4), (4, 4), (None, None), (None, 1), (9, 8), (8, 8)], key=str)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.content) for r in kept.collect()), key=str) == sorted([(1, 2), (4, 4), (None, 5), (8, 7)], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.groups(docs).collect() == [] and simhash.deduplicated(docs).collect() == []


def test_long_chain_is_one_component(spark):
    edges = spark.range(100).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r.root for r in components(edges).collect()} == {0}
    assert components(edges).count() == 100


def test_deduplicated_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(4, text), (9, text), (9, text), (3, None), (8, ""), (None, "alone here"), (None, "alone here"), (6, "other"), (6, "words")]
    docs = spark.createDataFrame([(*r, "s", 1, 2, "c") for r in rows], "doc_id long, text string, sig string, fp long, component_id int, content string")
    got = simhash.deduplicated(docs)
    assert got.columns == docs.columns
    want = {(d, c) for d, c in plain_components([r[0] for r in rows], [plain_fingerprint(r[1]) for r in rows])}
    found = got.collect()
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == sorted({c for _, c in want if c is not None})
    assert [r.text for r in found if r.doc_id is None] == ["alone here"]
    assert simhash.deduplicated(docs.where("false")).collect() == []
