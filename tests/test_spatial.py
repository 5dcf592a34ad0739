import math
import random

import pytest
from pyspark.sql import functions as F

from placetime.functions import geo
from placetime.operators import spatial
from placetime.operators.joins import fanout_report, hot_keys, salted_join


def haversine(a, b, c, d):
    x = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371000 * math.atan2(math.sqrt(x), math.sqrt(max(0, 1 - x)))


@pytest.fixture(scope="module")
def scattered(spark):
    rng = random.Random(5)
    rows = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(600)]
    # a third of all points in one spot
    rows += [(1000 + i, 10.0 + i * 1e-6, 20.0) for i in range(300)]
    return rows, spark.createDataFrame(rows, "id int, lat double, lon double")


def test_radius_join_everywhere_on_the_globe(spark, scattered):
    rows, points = scattered
    rng = random.Random(6)
    circles = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180), 10 ** rng.uniform(3, 7)) for i in range(40)]
    circles += [(100, 89.5, 0.0, 300e3), (101, -90.0, 5.0, 1e6), (102, 0.0, 180.0, 5e5), (103, 0.0, -180.0, 5e5), (104, 10.0, 20.0, 2.0), (105, 0.0, 0.0, 2e7)]
    table = spark.createDataFrame(circles, "c int, clat double, clon double, radius double")
    got = {(r.id, r.c) for r in spatial.points_within(points, table, ["id"]).collect()}
    pairs = spatial.points_within(points, table, ["id"]).count()
    want = {(p[0], c[0]) for p in rows for c in circles if haversine(c[1], c[2], p[1], p[2]) <= c[3]}
    assert got == want and pairs == len(want)


def test_box_join_and_brush_repeat_keys(spark):
    points = spark.createDataFrame([("g", "k", 1.0, 1.0), ("g", "k", 2.0, 2.0), ("g", "m", 9.0, 9.0)], "grp string, key string, lat double, lon double")
    boxes = spark.createDataFrame([(1,)], "b int").select("b", geo.box(1.0, 1.0, 2.0, 2.0).alias("box"))
    got = sorted(tuple(r) for r in spatial.brush(points, boxes, "grp", "key", "b").collect())
    assert got == [(1, "g", "k"), (1, "g", "k")]


def test_interval_join_mixes_lengths(spark):
    rng = random.Random(7)
    ranges = [(i, float(lo), float(lo + rng.choice([0, 1, 3, 50, 4000]))) for i, lo in enumerate(rng.sample(range(5000), 80))]
    spans = [(i, float(lo), float(lo + rng.choice([0, 0, 2, 900]))) for i, lo in enumerate(rng.sample(range(5000), 120))]
    a = spark.createDataFrame(ranges, "r int, low double, high double")
    b = spark.createDataFrame(spans, "s int, first double, last double")
    got = sorted((x.r, x.s) for x in spatial.overlapping_intervals(a, b, ["s"]).collect())
    want = sorted((r, s) for r, lo, hi in ranges for s, x, x1 in spans if lo < hi and x < hi and x1 >= lo)
    assert got == want


def test_hot_keys_are_those_with_more_than_a_share(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, 8).otherwise(F.col("id") + 10).alias("k"))
    hot = [tuple(r) for r in hot_keys(df, ["k"]).collect()]
    assert hot == [(spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).first()[0], math.ceil(4 / 3))]
    assert hot_keys(df.where("false"), ["k"]).collect() == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_a_plain_join(spark, how):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"))
    small = spark.range(400).select((F.col("id") % 200).alias("k"), F.col("id").alias("v"))
    if how != "inner":
        small = small.dropDuplicates(["k"]).select("k")
    got = salted_join(big, small, ["k"], ["id"], how)
    want = big.join(small, ["k"], how)
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_fanout_report(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (1,), (3,)], "k int")
    assert tuple(fanout_report(a, b, ["k"]).first()) == (2, 3, 4, 7, 7 / 3)


def test_pyramid_conserves_totals(spark):
    assert spatial.pyramid_depth(50, 20) == 5 and spatial.pyramid_depth(1, 9) == 0 and spatial.pyramid_depth(2, 2) == 1
    cells = spark.range(1000).select((F.col("id") % 50).alias("x"), (F.col("id") % 20).alias("y"), F.lit(1).alias("value"))
    levels = spatial.pyramid(cells, 50, 20).groupBy("level").agg(F.sum("value").alias("v"), F.max("x").alias("x")).collect()
    assert {r.v for r in levels} == {1000} and len(levels) == 6
    assert {r.level: r.x for r in levels}[1] == 24


def test_best_level(one):
    def level(w, h, a, b):
        return one(spatial.best_level(F.lit(w), F.lit(h), F.lit(a), F.lit(b)))

    assert level(100, 100, 30, 30) == 1
    assert level(100, 100, 200, 10) == 0
    assert level(100, 100, 1, 1) == 7
    assert level(100, 3, 1, 1) == 2


def test_resampling_covers_every_pixel_once(spark):
    cells = spark.range(12).select(F.lit("i").alias("image"), (F.col("id") % 3).alias("row"), F.floor(F.col("id") / 3).alias("col"), F.col("id").alias("value"))
    images = spark.createDataFrame([("i", 4, 3)], "image string, w int, h int").withColumn("box", geo.box(10.0, 10.0, 50.0, 60.0))
    placed = spatial.resample_cells(cells, images, 4).collect()
    painted = {}
    for r in placed:
        for x in range(r.pixel_x, r.pixel_x + r.size_x):
            for y in range(r.pixel_y, r.pixel_y + r.size_y):
                if 0 <= x < 256 and 0 <= y < 256:
                    spot = (r.tile_x * 256 + x, r.tile_y * 256 + y)
                    assert spot not in painted
                    painted[spot] = r.value
    xs, ys = {p[0] for p in painted}, {p[1] for p in painted}
    assert len(painted) == len(xs) * len(ys)
    assert max(xs) - min(xs) + 1 == len(xs)


def test_intervals_far_below_one_unit(spark):
    ranges = spark.range(400).select(F.col("id").alias("r"), (F.col("id") / 400.0).alias("low"), (F.col("id") / 400.0 + 0.001).alias("high"))
    spans = spark.range(400).select(F.col("id").alias("s"), (F.col("id") / 400.0 + 0.0005).alias("first"), (F.col("id") / 400.0 + 0.0005).alias("last"))
    joined = spatial.overlapping_intervals(ranges, spans, ["s"])
    assert sorted((r.r, r.s) for r in joined.collect()) == [(i, i) for i in range(400)]
    # every bucket holds a few intervals, not all of them
    wide = spans.withColumn("last", F.col("first") + 0.004)
    got = {(r.r, r.s) for r in spatial.overlapping_intervals(ranges, wide, ["s"]).collect()}
    want = {(i, j) for i in range(400) for j in range(400) if j / 400.0 + 0.0005 < i / 400.0 + 0.001 and j / 400.0 + 0.0005 + 0.004 >= i / 400.0}
    assert got == want


def plain_inside(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip([ring[-1], *ring[:-1]], ring, strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def test_polygon_cells_equal_the_plain_test(spark):
    rng = random.Random(4)

    def star(x, y, size, n):
        return [(x + size * r * math.cos(2 * math.pi * k / n), y + size * r * math.sin(2 * math.pi * k / n)) for k in range(n) for r in [rng.uniform(0.4, 1)]]

    shapes_ = [(i, [star(rng.uniform(-20, 20), rng.uniform(-20, 20), 10 ** rng.uniform(-2, 1.3), rng.choice([3, 8, 200]))]) for i in range(25)]
    square = [(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0)]
    shapes_ += [(100, [square, [(2.0, 2.0), (6.0, 2.0), (6.0, 6.0), (2.0, 6.0)]]), (101, [square]), (102, [[(1.0, 1.0), (1.0, 1.0)]]), (103, [[(-5.0, 3.0), (5.0, 3.0), (0.0, 3.0)]])]
    dots = [(i, rng.uniform(-30, 30), rng.uniform(-30, 30)) for i in range(3000)]
    dots += [(10_000 + 20 * a + b, a / 2.0, b / 2.0) for a in range(20) for b in range(20)]  # on sides, corners and cell borders
    points = spark.createDataFrame(dots, "id int, lon double, lat double")
    polygons = spark.createDataFrame([(i, [[{"x": x, "y": y} for x, y in r] for r in rings]) for i, rings in shapes_], "p int, rings array<array<struct<x:double,y:double>>>")
    want = sorted((d, p) for d, x, y in dots for p, rings in shapes_ if plain_inside(rings, x, y))
    for fineness in (1, 8):
        got = sorted((r.id, r.p) for r in spatial.points_in_polygons(points, polygons, fineness=fineness).collect())
        assert got == want
    cells = spatial.polygon_cells(polygons.where("p = 101")).select(F.size("_sides").alias("n")).collect()
    assert 0 in {r.n for r in cells} and max(r.n for r in cells) <= 3
