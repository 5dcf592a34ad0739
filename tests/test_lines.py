"""Lines of one row per vertex against plain loops."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from placetime.operators import lines


def plain_measures(line):
    steps = [math.dist(a, b) for a, b in zip(line, line[1:])]
    total, gone = sum(steps), 0.0
    for (ax, ay), (bx, by), d in zip(line, line[1:], steps):
        gone += d
        if total > 0 and gone > total / 2:
            back = (gone - total / 2) / d
            return total, bx - back * (bx - ax), by - back * (by - ay)
    return total, *line[0]


def plain_centroid(ring):
    sx = sy = area = 0.0
    for (ax, ay), (bx, by) in zip([ring[-1], *ring[:-1]], ring):
        cross = ay * bx - by * ax
        sx, sy, area = sx + (ax + bx) * cross, sy + (ay + by) * cross, area + 3 * cross
    return (sx / area, sy / area) if area else ring[0]


def frame(spark, made):
    rows = [(key, i, float(x), float(y)) for key, line in made.items() for i, (x, y) in enumerate(line)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k string, pos int, x double, y double").repartition(8)


MADE = {
    "one": [(3, 4)], "still": [(1, 1)] * 5, "two": [(0, 0), (4, 0)], "back": [(0, 0), (6, 0), (0, 0)], "flat": [(0, 0), (5, 0), (9, 0)],
    "square": [(0, 0), (2, 0), (2, 2), (0, 2)], None: [(1, 0), (1, 3), (5, 3)],
}


def test_a_line_of_many_vertices_dealt_over_tasks(spark):
    rng = random.Random(2)
    walk, x, y = [], 0.0, 0.0
    for k in range(100_000):
        x, y = x + rng.uniform(-1, 1.2), y + rng.uniform(-1, 1)
        walk.append((x, y))
    made = MADE | {"long": walk}
    df = frame(spark, made)
    for r in lines.line_measures(df, ["k"], ["pos"]).collect():
        want = plain_measures(made[r.k])
        assert (r.length, r.x, r.y) == pytest.approx(want, rel=1e-9), r.k
    got = {r.k: (r.x, r.y) for r in lines.ring_centroids(df, ["k"], ["pos"]).collect()}
    assert set(got) == set(made)
    for k, at in got.items():
        assert at == pytest.approx(plain_centroid(made[k]), rel=1e-6), k
    steps = lines.segments(df, ["k"], ["pos"])
    near = {r.k: r.distance for r in lines.nearest_to(steps, ["k"], 1.0, -2.0).collect()}
    assert near["square"] == 2.0 and "one" not in near and near["still"] == pytest.approx(3.0)
    assert steps.where("k = 'long'").count() == 100_000


def plain_nearest(px, py, ax, ay, bx, by):
    dx, dy = bx - ax, by - ay
    k = max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
    return math.hypot(px - ax - dx * k, py - ay - dy * k)


@pytest.mark.parametrize("kind", ["short", "long", "mixed", "far"])
def test_nearest_lines_equal_all_pairs(spark, kind):
    rng = random.Random(kind)
    parts = []
    for i in range(120):
        x, y = rng.uniform(0, 100), rng.uniform(0, 50)
        size = {"short": 0.5, "long": 80.0, "mixed": 10 ** rng.uniform(-3, 2), "far": 0.01}[kind]
        if kind == "far":
            x, y = x / 1000, y / 1000
        angle = rng.choice([0.0, math.pi / 2, rng.uniform(0, 7)])
        parts.append((i // 2, i % 2, x, y, x + size * math.cos(angle), y + size * math.sin(angle)))
    parts += [(500, 0, 5.0, 5.0, 5.0, 5.0), (501, 0, None, None, 9.0, 9.0), (502, 0, -100.0, 20.0, 200.0, 20.0)][: 3 if kind != "far" else 2]
    dots = [(i, rng.uniform(-20, 120), rng.uniform(-20, 70)) for i in range(400)] + [(i, 5.0, 5.0) for i in range(1000, 1300)] + [(2000, None, 1.0)]
    points = spark.createDataFrame(dots, "id int, x double, y double")
    segments = spark.createDataFrame(parts, "line int, part int, ax double, ay double, bx double, by double")
    got = {r.id: r for r in lines.nearest_lines(points, segments, ["id"], ["line", "part"]).collect()}
    assert set(got) == {d[0] for d in dots if d[1] is not None}
    for i, x, y in dots[:-1]:
        best = min(plain_nearest(x, y, *p[2:]) for p in parts if p[2] is not None)
        assert got[i].distance == pytest.approx(best, abs=1e-9)
        assert math.hypot(got[i].near_x - x, got[i].near_y - y) == pytest.approx(best, abs=1e-9)


def test_nearest_lines_of_nothing(spark):
    points = spark.createDataFrame([(1, 2.0, 3.0)], "id int, x double, y double")
    segments = spark.createDataFrame([], "line int, ax double, ay double, bx double, by double")
    none = lines.nearest_lines(points, segments, ["id"], ["line"])
    assert none.columns == ["id", "line", "distance", "near_x", "near_y"] and none.collect() == []
    one = segments.union(spark.createDataFrame([(1, 0.0, 0.0, 1.0, 0.0)], segments.schema))
    assert lines.nearest_lines(points.limit(0), one, ["id"], ["line"]).collect() == []
    assert lines.nearest_lines(points, one, ["id"], ["line"]).first().distance == pytest.approx(math.sqrt(10))


def test_listed_segments_are_never_broadcast(spark, monkeypatch):
    """A list of segments under cells looks as small as the segments to Spark, which would send it through the driver."""
    plans, kept = [], lines.checkpointed

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df)

    monkeypatch.setattr(lines, "checkpointed", noted)
    points = spark.range(2000).select(F.col("id"), (F.col("id") * 7919 % 1000 / 10.0).alias("x"), (F.col("id") * 613 % 1000 / 10.0).alias("y"))
    segments = spark.createDataFrame([(1, 0, 0.0, 0.0, 100.0, 90.0), (2, 0, 0.0, 5.0, 100.0, 99.0)], "line int, part int, ax double, ay double, bx double, by double")
    near = lines.nearest_lines(points, segments, ["id"], ["line", "part"])
    plans.append(near._jdf.queryExecution().executedPlan().toString())
    joins = [p for p in plans if "_cx" in p and "Join" in p]
    assert len(joins) == 2
    assert "BroadcastHashJoin" not in joins[0] and "SortMergeJoin" in joins[0]
    assert joins[1].count("BroadcastExchange") <= 3  # the bounded levels
    assert near.count() == 2000


def written_files(spark):
    """Sizes of the files of shuffles and spills by their path."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {os.path.join(at, f): os.path.getsize(os.path.join(at, f)) for d in folders for at, _, files in os.walk(d) for f in files}


def test_long_segments_take_little_disk(spark):
    """Each of many long segments passes over a hundred points; none is written once for every point on its way."""
    points = spark.range(20_000).select(F.col("id"), (F.col("id") * 7919 % 10007 / 100.07).alias("x"), (F.col("id") * 613 % 10009 / 100.09).alias("y"))
    n = F.col("id")
    segments = spark.range(2000).select(n.alias("line"), (n % 97 / 50).alias("ax"), (n % 89 / 50).alias("ay"), (100 - n % 83 / 50).alias("bx"), (100 - n % 79 / 50).alias("by"))
    before = written_files(spark)
    near = lines.nearest_lines(points, segments, ["id"], ["line"])
    rows = near.collect()
    written = sum(size for path, size in written_files(spark).items() if path not in before)
    assert len(rows) == 20_000 and 0 < written < 8_000_000
    got, dots, parts = {r.id: r for r in rows}, points.where("id % 400 = 7").collect(), [tuple(r) for r in segments.collect()]
    for i, x, y in dots:
        best = min((plain_nearest(x, y, *p[1:]), p[0]) for p in parts)
        assert got[i].distance == pytest.approx(best[0], abs=1e-9)


def test_nearest_lines_of_repeated_points_and_equal_distances(spark):
    """A point that comes often has one row; a busy place is dealt over shares; of equal distances the least line and place count."""
    dots = [(i, 1.0, 1.0) for i in range(5000)] * 2 + [(None, 1.0, 1.0)] * 3 + [(None, 7.0, 0.0), (7, 7.0, 0.0)] + [(9000 + i, i / 10, 90.0) for i in range(20)]
    points = spark.createDataFrame(dots, "id int, x double, y double")
    sides = [("b", 0.0, 0.0, 2.0, 0.0), ("a", 0.0, 2.0, 2.0, 2.0), ("a", 0.0, 0.0, 2.0, 0.0), ("c", 1.0, 1.0, 1.0, 1.0), (None, 8.0, -1.0, 8.0, 1.0), ("a", 6.0, -1.0, 6.0, 1.0)]
    schema = "line string, ax double, ay double, bx double, by double"
    rows = lines.nearest_lines(points, spark.createDataFrame([s for s in sides if s[0] != "c"], schema), ["id"], ["line"]).collect()
    assert len(rows) == len(set(dots)) == 5023
    assert all((r.line, r.distance, r.near_x, r.near_y) == ("a", 1.0, 1.0, 0.0) for r in rows if r.id is not None and r.id < 5000 and r.near_x < 2)
    assert sorted(r.line is None for r in rows if r.near_x > 2 and r.distance == 1.0) == [True, True]
    assert {r.distance for r in rows if r.id is not None and r.id >= 9000} == {88.0}
    rows = lines.nearest_lines(points, spark.createDataFrame(sides, schema), ["id"], ["line"]).where("distance = 0").collect()
    assert len(rows) == 5001 and {r.line for r in rows} == {"c"}


def test_nearest_of_many_segments_to_few_points(spark):
    """Few points are dealt by the number of segments, so that no block lists most of these."""
    points = spark.createDataFrame([(1, 10.0, 10.0), (2, 90.0, 20.0), (3, 50.0, 95.0), (4, 20.0, 70.0)], "id int, x double, y double")
    n = F.col("id")
    ax, ay = n * 7919 % 100003 / 1000.03, n * 613 % 100019 / 1000.19
    segments = spark.range(80_000).select(n.alias("line"), ax.alias("ax"), ay.alias("ay"), (ax + n % 7 / 9).alias("bx"), (ay + n % 5 / 9).alias("by"))
    near = lines.nearest_lines(points, segments, ["id"], ["line"])
    got, parts = {r.id: r for r in near.collect()}, [tuple(r) for r in segments.collect()]
    assert len(got) == 4
    for i, x, y in points.collect():
        best = min((plain_nearest(x, y, *p[1:]), p[0]) for p in parts)
        assert got[i].distance == pytest.approx(best[0], abs=1e-9)
