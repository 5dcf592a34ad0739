import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from placetime.operators import events
from placetime.session import checkpointed, fresh_path
from placetime.streaming.throttle import run_to_table, throttle_stream


def plain_throttle(rows, wait_ms):
    kept, last = [], {}
    for key, at, tie in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if key not in last or at >= last[key] + wait_ms * 1000:
            last[key] = at
            kept.append((key, at, tie))
    return sorted(kept, key=repr)


def sample(seed, size):
    rng = random.Random(seed)
    # two thirds of the events belong to one key, many at one instant
    keys = ["hot"] * 4 + ["a", None]
    rows = [(rng.choice(keys), rng.choice([rng.randrange(3_000_000), 1_234_567, rng.randrange(50) * 50_000]), i) for i in range(size)]
    return rows


def frame(spark, rows, kind):
    df = spark.createDataFrame(rows, "k string, at bigint, n bigint")
    ts = F.timestamp_micros("at") if kind == "timestamp" else F.timestamp_add("MICROSECOND", F.col("at"), F.lit("1970-01-01 00:00:00").cast(kind))
    return df.select("k", ts.alias("ts"), "n")


def micros(df):
    return sorted(((r.k, r.at, r.n) for r in df.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp"))).collect()), key=repr)


@pytest.mark.parametrize("wait_ms,ranges,kind", [(50, None, "timestamp"), (50, 1, "timestamp_ntz"), (50, 20, "timestamp"), (7, 40, "timestamp"), (900, 300, "timestamp")])
def test_throttle_equals_a_plain_loop(spark, wait_ms, ranges, kind):
    rows = sample(wait_ms, 3000)
    got = micros(events.throttle(frame(spark, rows, kind), "k", "ts", "n", wait_ms, ranges, fan_in=4))
    assert got == plain_throttle(rows, wait_ms)
    by_key = {}
    for k, at, _ in got:
        by_key.setdefault(k, []).append(at)
    for times in by_key.values():
        times.sort()
        assert all(b - a >= wait_ms * 1000 for a, b in zip(times, times[1:]))


@pytest.mark.parametrize("wait_ms", [3, 40, 2000])
def test_throttle_of_one_key_over_many_tasks(spark, monkeypatch, wait_ms):
    rng = random.Random(wait_ms)
    rows = [("one", rng.randrange(3_000_000), i) for i in range(4000)]
    cuts = []
    monkeypatch.setattr(events, "checkpointed", lambda df: cuts.append(checkpointed(df)) or cuts[-1])
    assert micros(events.throttle(frame(spark, rows, "timestamp"), "k", "ts", "n", wait_ms, 64, fan_in=2)) == plain_throttle(rows, wait_ms)
    per_range = [r["count"] for r in cuts[0].groupBy("_range").count().collect()]
    assert len(per_range) == 64 and max(per_range) < 3 * 4000 / 64


def test_throttle_over_many_keys_of_all_densities(spark):
    rng = random.Random(9)
    rows = [
        (f"k{k}", rng.randrange(20) * 1000 if k % 5 == 0 else rng.randrange(10 ** (3 + k % 4)) * 100, k * 100 + i)
        for k in range(150) for i in range(80)
    ]
    df = frame(spark, rows, "timestamp").cache()
    for wait_ms, ranges in ((5, 7), (30, 100), (100, 30)):
        assert micros(events.throttle(df, "k", "ts", "n", wait_ms, ranges)) == plain_throttle(rows, wait_ms)


def test_throttle_before_1970_and_layout(spark):
    rows = [(k, at - 5_000_000, n) for k, at, n in sample(1, 500)]
    for parts in (1, 8):
        assert micros(events.throttle(frame(spark, rows, "timestamp").repartition(parts), "k", "ts", "n", 50, 12)) == plain_throttle(rows, 50)
    assert events.throttle(frame(spark, rows, "timestamp").where("false"), "k", "ts", "n").collect() == []


def test_whole_groups_regroups_frames():
    data = pd.DataFrame({"k": ["a", "a", "b", None, None, "c"], "v": range(6)})
    for cut in range(1, 7):
        frames = [data.iloc[i:i + cut] for i in range(0, 6, cut)]
        for rows in (1, 2, 100):
            blocks = list(events.whole_groups(iter(frames), ["k"], rows))
            flat = [k for f in blocks for k in sorted(set(f["k"].astype(str)))]
            assert len(flat) == len(set(flat)) == 4
            assert list(pd.concat(blocks)["v"]) == list(range(6))


def test_batches(spark):
    df = spark.createDataFrame([(1, list(range(45))), (2, [7]), (3, []), (4, None)], "e int, items array<int>")
    got = sorted((r.e, r.batch, len(r.items), r.items[0]) for r in events.batches(df, "items").collect())
    assert got == [(1, 0, 20, 0), (1, 1, 20, 20), (1, 2, 5, 40), (2, 0, 1, 7)]


def test_stream_keeps_state_between_batches(spark):
    folder = fresh_path(spark, "stream-in")
    first = [("a", 1_000_000, 1), ("a", 1_020_000, 2), ("a", 1_060_000, 3), ("b", 5, 4)]
    second = [("a", 1_100_000, 5), ("a", 1_110_000, 6), ("a", 900_000, 7), ("b", 6, 8)]
    out, state = fresh_path(spark, "stream-out"), fresh_path(spark, "stream-state")
    schema = frame(spark, first, "timestamp").schema
    kept = None
    for batch in (first, second):
        frame(spark, batch, "timestamp").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        kept = run_to_table(throttle_stream(stream, "k", "ts", "n", 50), out, state)
    assert micros(kept) == [("a", 1_000_000, 1), ("a", 1_060_000, 3), ("a", 1_110_000, 6), ("b", 5, 4)]
    assert kept.where("n = 6").first()["late"] == 1
