"""Shards against a tree that is cut by plain loops."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from placetime.llm import shards

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain(rows, count=shards.SHARDS):
    """Shard of every row (doc_id, text, lang, source, n_chars)."""
    def point(r):
        text = (r[1] or "").encode()
        crc = zlib.crc32(text)
        tie = xxhash.xxh64_intdigest(f"{'' if r[0] is None else r[0]}:{crc}".encode(), 42)
        at = [None if v is None else float(int.from_bytes(v.encode()[:6].ljust(6, b"\0"), "big")) for v in r[2:4]]
        at.append(None if r[4] is None else math.copysign(math.log1p(abs(r[4])), r[4]))
        return len(text) + 8, tie >> (64 - shards.TIES), at

    points = [point(r) for r in rows]
    ends = []
    for d in range(3):
        values = [p[2][d] for p in points if p[2][d] is not None] or [0.0]
        ends.append((min(values), max(values)))

    def step(v, low, high):
        return 0 if v is None else 1 + math.floor((v - low) * ((shards.BINS - 2) / (high - low) if high > low else 0.0))

    where = [[step(v, *e) for v, e in zip(p[2], ends, strict=True)] for p in points]
    out = [0] * len(rows)

    def cut(members, first, k):
        if k == 1 or not members:
            for i in members:
                out[i] = first
            return
        wide = [max(where[i][d] for i in members) - min(where[i][d] for i in members) for d in range(3)]
        d = wide.index(max(wide))
        aim = sum(points[i][0] for i in members) * (k // 2) / k
        total, at = 0, None
        for s, n in sorted(_sums((where[i][d], points[i][0]) for i in members).items()):
            if total + n >= aim:
                at = s
                break
            total += n
        best, upto = (aim - total, 0), 0
        for t, n in sorted(_sums((points[i][1], points[i][0]) for i in members if where[i][d] == at).items()):
            upto += n
            best = min(best, (abs(upto - (aim - total)), t + 1))
        left = [i for i in members if (where[i][d], points[i][1]) < (at, best[1])]
        cut(left, first, k // 2)
        cut([i for i in members if i not in set(left)], first + k // 2, k - k // 2)

    cut(list(range(len(rows))), 0, count)
    return out


def _sums(pairs):
    found = Counter()
    for key, n in pairs:
        found[key] += n
    return found


def corpus(n=1500):
    rng = random.Random(5)
    rows = [(i, "same text " * 20, "en", "src1", 200) for i in range(n // 3)]
    for i in range(n // 3, n):
        text = "x" * rng.randint(0, 400)
        rows.append((i, text, rng.choice(["de", "en", None, "fr"]), rng.choice([f"src{k}" for k in range(30)] + [None, "é"]), rng.choice([len(text), None])))
    return rows + [(None, None, None, None, None), (None, "no id", "en", "s", 5), (5, "twice", "de", "s", 5), (5, "twice", "de", "s", 5), (9_000, "ü" * 3000, "de", "s", 3000)]


@pytest.mark.parametrize("count", [1, 2, 7, 24])
def test_against_plain_loops(spark, count):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", size int, node int, mark int").repartition(5)
    key = lambda r: tuple(map(str, r))
    got = shards.with_shard(docs, count)
    assert got.columns == [*docs.columns, "shard"]
    assert sorted(((*r[:5], r["shard"]) for r in got.collect()), key=key) == sorted(((*r, s) for r, s in zip(rows, plain(rows, count), strict=True)), key=key)
    placed = shards.placed(docs, count, chunk=16).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard) for r in placed) == Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode()), s) for r, s in zip(rows, plain(rows, count), strict=True))
    slots = defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
    assert len(slots) == count and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_bytes_are_near_equal(spark, sf):
    docs = spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet")
    sizes = [r[1] for r in shards.placed(docs).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) < docs.agg(F.max(F.octet_length("text"))).first()[0]
    equal = spark.range(24_000).select("id", F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars")).withColumnRenamed("id", "doc_id")
    counts = [r[1] for r in shards.placed(equal).groupBy("shard").count().collect()]
    assert len(counts) == 24 and max(counts) <= 1.02 * min(counts)


def test_leaves_of_a_target_size(spark):
    docs = spark.createDataFrame(corpus(300), SCHEMA)
    total = sum(r.size for r in shards.placed(docs).collect())
    assert {r.shard for r in shards.placed(docs, target_bytes=10_000).collect()} == set(range(math.ceil(total / 10_000)))


def test_empty_table_and_native_plan(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert shards.placed(docs).collect() == [] and shards.with_shard(docs).collect() == []
    found = shards.placed(spark.createDataFrame(corpus(30), SCHEMA), 4)
    assert "Python" not in found._jdf.queryExecution().toString()
