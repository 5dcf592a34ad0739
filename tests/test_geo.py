import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from placetime.functions import geo, shapes, values
from placetime.operators import spatial


def test_great_circle(one):
    quarter = math.pi / 2 * 6371000
    assert one(geo.great_circle(0.0, 0.0, 0.0, 90.0)) == pytest.approx(quarter)
    assert one(geo.great_circle(90.0, 10.0, -90.0, 77.0)) == pytest.approx(2 * quarter)
    assert one(geo.great_circle(5.0, 6.0, 5.0, 6.0)) == 0.0


def test_projections_round_trip(spark):
    df = spark.range(400).select(
        (F.col("id") * 0.42 - 84).alias("lat"), (F.col("id") * 0.9 - 179.5).alias("lon")
    ).withColumns({"m": geo.mercator_xy("lat", "lon"), "e": geo.ellipsoid_xy("lat", "lon")})
    back = df.withColumns({"b": geo.mercator_latlon("m.x", "m.y"), "c": geo.ellipsoid_latlon("e.x", "e.y")})
    worst = back.agg(
        F.max(F.abs(F.col("b.lat") - F.col("lat"))), F.max(F.abs(F.col("b.lon") - F.col("lon"))),
        F.max(F.abs(F.col("c.lat") - F.col("lat"))), F.max(F.abs(F.col("c.lon") - F.col("lon"))),
    ).first()
    assert worst[0] < 1e-9 and worst[1] < 1e-9 and worst[2] < 1e-5 and worst[3] < 1e-9


def test_projection_limits(one):
    top = one(geo.mercator_xy(90.0, 180.0))
    assert top["x"] == pytest.approx(math.pi * 6378137)
    assert top["y"] == pytest.approx(math.pi * 6378137, rel=1e-9)


def test_pixels_and_tiles(one):
    assert tuple(one(geo.pixel_position(0.0, 0.0, 0))) == (128.0, 128.0)
    assert tuple(one(geo.pixel_position(90.0, -180.0, 1, "EPSG:4326"))) == (0.0, 0.0)
    assert tuple(one(geo.pixel_position(2.0, 3.0, 2, "Simple"))) == (12.0, -8.0)
    tile = one(geo.tile_index(39.5, -103.5, 4))
    assert (tile["x"], tile["y"]) == (3, 6)
    assert one(geo.tile_key(F.lit(3), F.lit(6), 4)) == "3:6:4"
    with pytest.raises(ValueError):
        geo.pixel_position(0.0, 0.0, 0, "EPSG:1")


def test_tiles_over(one):
    assert one(geo.tiles_over(0.0, 256.0)) == [0]
    assert one(geo.tiles_over(-1.0, 257.0)) == [-1, 0, 1]
    assert one(geo.tiles_over(256.0, 256.0)) == []


def test_wrap(one):
    assert [one(geo.wrap_longitude(v)) for v in (190.0, -190.0, 180.0, -180.0, 540.0)] == [-170.0, 170.0, 180.0, -180.0, -180.0]
    assert one(geo.wrap_longitude(180.0, keep_high=False)) == -180.0


def test_boxes(one):
    a, b, c = geo.box(0.0, 0.0, 2.0, 2.0), geo.box(2.0, 2.0, 3.0, 3.0), geo.box(0.5, 0.5, 1.0, 1.0)
    assert one(geo.box_intersects(a, b)) and not one(geo.box_overlaps(a, b))
    assert one(geo.box_contains(a, c)) and not one(geo.box_contains(c, a))
    assert one(geo.box_contains_point(a, 2.0, 2.0))
    assert tuple(one(geo.box_pad(a, 0.5))) == (-1.0, -1.0, 3.0, 3.0)
    assert one(geo.box_text(b)) == "2.0,2.0,3.0,3.0"
    around = one(geo.box_around(60.0, 10.0, 1000.0))
    assert around["north"] - 60 == pytest.approx(180 * 1000 / 40075017)
    assert around["east"] - 10 == pytest.approx((around["north"] - 60) / math.cos(math.radians(60)))
    assert one(geo.same_point(1.0, 1.0, 1.0 + 5e-10, 1.0)) and not one(geo.same_point(1.0, 1.0, 1.0, 1.0 + 2e-9))


def test_view_zoom(one):
    world = geo.box(-85.0, -180.0, 85.0, 180.0)
    assert one(geo.view_zoom(world, 256, 256)) == 0.0
    assert one(geo.view_zoom(world, 1024, 1024)) == 2.0
    assert one(geo.view_zoom(geo.box(5.0, 5.0, 5.0, 5.0), 800, 600)) == 16.0
    assert one(geo.view_zoom(geo.box(5.0, 5.0, 5.0, 5.0), 800, 600, high=10.0)) == 10.0


def test_clip_segment(one):
    b = geo.box(0.0, 0.0, 10.0, 10.0)
    assert tuple(one(geo.clip_segment(-5.0, 5.0, 15.0, 5.0, b))) == (0.0, 5.0, 10.0, 5.0)
    assert one(geo.clip_segment(-5.0, 20.0, 15.0, 20.0, b)) is None
    assert one(geo.clip_segment(-5.0, -20.0, -5.0, 20.0, b)) is None
    assert tuple(one(geo.clip_segment(3.0, 3.0, 3.0, 3.0, b))) == (3.0, 3.0, 3.0, 3.0)


def test_clipped_segments_stay_inside_and_on_the_segment(spark):
    df = spark.range(3000).select(*(
        (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(3000)) / 100.0 - 10).alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))
    ))
    got = df.select("*", geo.clip_segment("x1", "y1", "x2", "y2", geo.box(0.0, 0.0, 10.0, 10.0)).alias("p")).collect()
    for r in got:
        ends = np.array([[r.x1, r.y1], [r.x2, r.y2]])
        probe = ends[0] + np.linspace(0, 1, 201)[:, None] * (ends[1] - ends[0])
        inside = ((probe >= -1e-9) & (probe <= 10 + 1e-9)).all(axis=1)
        if r.p is None:
            assert not inside.any()
        else:
            assert all(-1e-9 <= v <= 10 + 1e-9 for v in r.p)
            first, last = probe[inside][0] if inside.any() else None, None
            if first is not None:
                step = np.abs(ends[1] - ends[0]).max() / 200 + 1e-9
                assert np.abs(first - [r.p.x1, r.p.y1]).max() <= step


def test_nearest_on_segment(one):
    assert tuple(one(geo.nearest_on_segment(5.0, 5.0, 0.0, 0.0, 10.0, 0.0))) == (5.0, 0.0, 5.0)
    assert tuple(one(geo.nearest_on_segment(-3.0, 4.0, 0.0, 0.0, 10.0, 0.0))) == (0.0, 0.0, 5.0)
    assert one(geo.nearest_on_segment(3.0, 4.0, 0.0, 0.0, 0.0, 0.0))["distance"] == 5.0


def ring(*points):
    return F.array(*(shapes.vertex(F.lit(float(x)), F.lit(float(y))) for x, y in points))


SQUARE = ((0, 0), (4, 0), (4, 4), (0, 4))


def test_centroid_and_midpoint(one):
    assert tuple(one(shapes.ring_centroid(ring(*SQUARE)))) == (2.0, 2.0)
    assert tuple(one(shapes.ring_centroid(ring((1, 1), (3, 1))))) == (1.0, 1.0)
    assert tuple(one(shapes.line_midpoint(ring((0, 0), (4, 0), (4, 10))))) == (4.0, 3.0)
    assert tuple(one(shapes.line_midpoint(ring((7, 8), (7, 8))))) == (7.0, 8.0)
    assert one(shapes.line_length(ring((0, 0), (3, 4), (3, 5)))) == 6.0


def test_point_in_polygon_with_a_hole(one):
    rings = F.array(ring(*SQUARE), ring((1, 1), (3, 1), (3, 3), (1, 3)))
    assert one(shapes.contains_point(rings, F.lit(0.5), F.lit(0.5))) is True
    assert one(shapes.contains_point(rings, F.lit(2.0), F.lit(2.0))) is False
    assert one(shapes.contains_point(rings, F.lit(9.0), F.lit(2.0))) is False


def test_clip_ring(spark):
    df = spark.range(1).select(ring((-2, 1), (2, 1), (2, 3), (-2, 3)).alias("r"), geo.box(0.0, 0.0, 10.0, 10.0).alias("b"))
    got = shapes.clip_rings(df, "r", "b", "c").first()["c"]
    assert sorted((v.x, v.y) for v in got) == [(0.0, 1.0), (0.0, 3.0), (2.0, 1.0), (2.0, 3.0)]
    away = spark.range(1).select(ring((-2, 1), (-1, 1), (-1, 3)).alias("r"), geo.box(0.0, 0.0, 10.0, 10.0).alias("b"))
    assert shapes.clip_rings(away, "r", "b", "c").first()["c"] == []


def test_simplified_lines_stay_within_tolerance(spark):
    rng = np.random.default_rng(3)
    lines = [(i, [(float(x), float(y)) for x, y in np.cumsum(rng.normal(size=(n, 2)), axis=0)]) for i, n in enumerate((1, 2, 3, 50, 300))]
    df = spark.createDataFrame(lines, f"id int, line array<{shapes.VERTEX}>")
    for r in spatial.simplify_lines(df, "line", 1.5, "simple").collect():
        line, simple = np.array(r.line), np.array(r.simple)
        assert (simple[0] == line[0]).all() and (simple[-1] == line[-1]).all()
        assert len(simple) <= len(line)
        if len(simple) < 2:
            continue
        a, b = simple[:-1, None], simple[1:, None]
        d = b - a
        k = np.clip(((line[None] - a) * d).sum(2) / np.maximum((d * d).sum(2), 1e-300), 0, 1)
        off = np.sqrt((((a + k[..., None] * d) - line[None]) ** 2).sum(2)).min(axis=0)
        # dropped first for lying near a kept vertex, then for lying near a chord
        assert off.max() <= 1.5 * 2 + 1e-9


def test_values_on_arrays(one, spark):
    assert one(values.transpose(F.expr("array(array(1,2,3),array(4,5,6))"))) == [[1, 4], [2, 5], [3, 6]]
    assert one(values.transpose(F.expr("cast(array() as array<array<int>>)"))) == []
    rows = one(values.zip_rows(a=F.expr("array(1,2)"), b=F.expr("array('x','y')")))
    assert [tuple(r) for r in rows] == [(1, "x"), (2, "y")]
    with pytest.raises(Exception, match="same length"):
        one(values.zip_rows(a=F.expr("array(1,2)"), b=F.expr("array('x')")))
    with pytest.raises(Exception, match="same length"):
        one(values.zip_rows(a=F.expr("array(1,2)"), b=F.expr("cast(null as array<int>)")))
    assert one(values.chunks(F.sequence(F.lit(1), F.lit(5)), 2)) == [[1, 2], [3, 4], [5]]
    assert [one(values.recycle(["a", "b"], F.lit(i))) for i in range(4)] == ["a", "b", "a", "b"]
    assert [one(values.decode(["u", "v"], F.lit(i))) for i in (-1, 0, 1, 2)] == [None, "u", "v", None]
    merged = one(values.merge_options(
        F.expr("map('a','1','b','1')"), F.expr("cast(null as map<string,string>)"), F.expr("map('b','3','c','3')")
    ))
    assert merged == {"a": "1", "b": "3", "c": "3"}
