"""Spatial joins, clustering, pyramids and line work on point and shape tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetime.functions import geo, shapes
from placetime.operators.joins import salted_join

TILE_PIXELS = 256  # fixed value: side of a map tile
_SMALLEST_SIDE = 1e-6
IMAGE_BLOCK = 256  # rows and columns of an image that share a key


# --- cells ----------------------------------------------------------------------

def _cover(df: DataFrame, boxes: Column, fineness: int) -> DataFrame:
    """Repeat each shape for the grid cells its boxes touch.

    The cell size follows the shape's own size, so a shape of any size touches at most
    ``(fineness + 1) ** 2`` cells per box.
    """
    one = df.withColumn("_box", F.explode(boxes))
    b = F.col("_box")
    side = F.greatest(b["north"] - b["south"], b["east"] - b["west"], F.lit(_SMALLEST_SIDE))
    level = F.ceil(F.log2(side)).cast("int")
    cell = F.pow(F.lit(2.0), F.col("_level")) / fineness
    return (
        one.withColumn("_level", level)
        .withColumn("_cell", cell)
        .withColumn("_cx", F.explode(F.sequence(F.floor(b["west"] / F.col("_cell")), F.floor(b["east"] / F.col("_cell")))))
        .withColumn("_cy", F.explode(F.sequence(F.floor(b["south"] / F.col("_cell")), F.floor(b["north"] / F.col("_cell")))))
        .drop("_cell")
    )


def points_meet_shapes(
    points: DataFrame, made: DataFrame, lat: str, lon: str, boxes: Column, spread_by: list[str], fineness: int = 4,
) -> DataFrame:
    """Candidate pairs by grid cell: every point with the shapes whose box holds it.

    Points are repeated once per shape size class in use. A shape has one class and
    lists a cell once, so no pair comes twice. Busy cells are spread over tasks.
    """
    covered = _cover(made, boxes, fineness)
    levels = covered.agg(F.collect_set("_level")).scalar()
    cell = F.pow(F.lit(2.0), F.col("_level")) / fineness
    placed = (
        points.withColumn("_levels", levels)
        .withColumn("_level", F.explode("_levels"))
        .withColumns({"_cx": F.floor(F.col(lon) / cell), "_cy": F.floor(F.col(lat) / cell)})
        .drop("_levels")
    )
    pairs = salted_join(placed, covered, ["_level", "_cx", "_cy"], spread_by)
    inside = geo.box_contains_point("_box", lat, lon)
    return pairs.where(inside).drop("_level", "_cx", "_cy", "_box")


def points_in_boxes(points: DataFrame, boxes: DataFrame, spread_by: list[str], box: str = "box",
                    lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Range join: each point with each box that holds it, borders included."""
    return points_meet_shapes(points, boxes, lat, lon, F.array(F.col(box)), spread_by)


def brush(points: DataFrame, boxes: DataFrame, group: str, key: str, box_id: str) -> DataFrame:
    """Keys selected by a brush, per box and link group, once for every point inside."""
    return points_in_boxes(points, boxes, spread_by=[key, "lat", "lon"]).select(box_id, group, key)


def ring_box(ring: Column | str) -> Column:
    ring = F.col(ring) if isinstance(ring, str) else ring
    xs, ys = F.transform(ring, lambda v: v["x"]), F.transform(ring, lambda v: v["y"])
    return geo.box(F.array_min(ys), F.array_min(xs), F.array_max(ys), F.array_max(xs))


def polygon_cells(polygons: DataFrame, rings: str = "rings", fineness: int = 8) -> DataFrame:
    """Grid cells of each polygon that can hold a point of it: _level, _cx, _cy and _sides, the rings left out.

    A cell that no side comes near lies wholly inside, with no sides, or outside, and is left out.
    A border cell has the sides of its row of cells that do not end west of it: those that a ray
    from one of its points to the east can meet. Cells have a size that follows the polygon's own.
    """
    sided = polygons.withColumn("_box", ring_box(F.flatten(rings))).withColumn("_all", shapes.all_sides(rings)).drop(rings)
    b = F.col("_box")
    side = F.greatest(b["north"] - b["south"], b["east"] - b["west"], F.lit(_SMALLEST_SIDE))
    leveled = sided.withColumn("_level", F.ceil(F.log2(side)).cast("int")).withColumn("_cell", F.pow(F.lit(2.0), F.col("_level")) / fineness)
    cell = F.col("_cell")
    slack = cell * 1e-6  # rounding must not bring a side into a cell that it does not touch, or keep it out

    rows = leveled.withColumn("_cy", F.explode(F.sequence(F.floor(b["south"] / cell), F.floor(b["north"] / cell))))
    south, north = F.col("_cy") * cell - slack, (F.col("_cy") + 1) * cell + slack
    low, high = (lambda s, f=f: f(s["a"]["y"], s["b"]["y"]) for f in (F.least, F.greatest))
    band = F.filter("_all", lambda s: (high(s) >= south) & (low(s) <= north))

    def reach(s: Column) -> Column:
        """The side with the stretch of x that it covers in the row of cells."""
        a, b_ = s["a"], s["b"]
        slope = (b_["x"] - a["x"]) / F.nullif(b_["y"] - a["y"], F.lit(0.0))
        at = lambda y: a["x"] + slope * (F.least(high(s), F.greatest(low(s), y)) - a["y"])
        first, last = F.coalesce(at(south), a["x"]), F.coalesce(at(north), b_["x"])
        return F.struct(a.alias("a"), b_.alias("b"), F.least(first, last).alias("low"), F.greatest(first, last).alias("high"))

    rows = rows.withColumn("_band", F.transform(band, reach)).drop("_all")
    cells = rows.withColumn("_cx", F.explode(F.sequence(F.floor(b["west"] / cell), F.floor(b["east"] / cell))))
    west, east = F.col("_cx") * cell - slack, (F.col("_cx") + 1) * cell + slack
    near = F.exists("_band", lambda s: (s["high"] >= west) & (s["low"] <= east))
    inside = shapes.odd_crossings("_band", (F.col("_cx") + 0.5) * cell, (F.col("_cy") + 0.5) * cell)
    ahead = F.filter("_band", lambda s: F.greatest(s["a"]["x"], s["b"]["x"]) >= west)
    bare = F.transform(ahead, lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b")))
    return (
        cells.withColumn("_sides", F.when(near, bare).when(inside, F.array().cast(f"array<struct<a:{shapes.VERTEX},b:{shapes.VERTEX}>>")))
        .where(F.col("_sides").isNotNull()).drop("_band", "_box", "_cell")
    )


def points_in_polygons(points: DataFrame, polygons: DataFrame, rings: str = "rings", lat: str = "lat", lon: str = "lon", fineness: int = 8) -> DataFrame:
    """Each point with each polygon that contains it (even-odd over all rings), the rings left out.

    ``points`` is read once: a point meets the cell that it lies in, at once inside or with the few
    sides of that cell to test. A cell with a large share of all points is split by adaptive execution,
    which repeats the rows of that cell alone.
    """
    cells = polygon_cells(polygons, rings, fineness)
    levels = cells.agg(F.collect_set("_level")).scalar()
    cell = F.pow(F.lit(2.0), F.col("_level")) / fineness
    placed = (
        points.withColumn("_levels", levels).withColumn("_level", F.explode("_levels"))
        .withColumns({"_cx": F.floor(F.col(lon) / cell), "_cy": F.floor(F.col(lat) / cell)}).drop("_levels")
    )
    pairs = placed.join(cells, ["_level", "_cx", "_cy"])
    return pairs.where((F.size("_sides") == 0) | shapes.odd_crossings("_sides", lon, lat)).drop("_level", "_cx", "_cy", "_sides")


def circle_boxes(lat: str, lon: str, metres: str) -> Column:
    """Boxes that hold every point within a distance; two of them across the 180th meridian."""
    reach = F.col(metres) / geo.EARTH_RADIUS
    up = F.degrees(reach)
    south, north = F.col(lat) - up, F.col(lat) + up
    polar = (south <= -90) | (north >= 90)
    across = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(reach) / F.cos(F.radians(lat)))))
    slack = 1e-9  # rounding of the reach must not lose a point on the rim
    south, north = south - slack, north + slack
    west, east = F.col(lon) - across - slack, F.col(lon) + across + slack

    def one(w: Column, e: Column) -> Column:
        return geo.box(south, w, north, e)

    low, high = F.lit(-180.0), F.lit(180.0)
    return (
        F.when(polar | (across >= 180), F.array(one(low, high)))
        .when(west < low, F.array(one(low, east), one(west + 360, high)))
        .when(east > high, F.array(one(west, high), one(low, east - 360)))
        .otherwise(F.array(one(west, east)))
    )


def points_within(points: DataFrame, circles: DataFrame, spread_by: list[str], lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Each point with each circle (clat, clon, radius in metres) it lies in, with the distance."""
    pairs = points_meet_shapes(points, circles, lat, lon, circle_boxes("clat", "clon", "radius"), spread_by)
    return pairs.withColumn("distance", geo.great_circle("clat", "clon", lat, lon)).where(
        F.col("distance") <= F.col("radius")
    )


# --- intervals --------------------------------------------------------------------

def overlapping_intervals(ranges: DataFrame, spans: DataFrame, spread_by: list[str], unit: float = 1.0) -> DataFrame:
    """Pairs of a range [low, high) and a span (first, last) with first < high and last >= low.

    Each interval lives in buckets of about its own length (two at most) and is also
    listed in the coarser buckets the other side uses, so long and short intervals mix
    without long lists. A pair is taken only in the first bucket both share.
    """
    def level(low: str, high: str) -> Column:
        return F.ceil(F.log2((F.col(high) - F.col(low)).cast("double") / unit)).cast("int")

    def listed(df: DataFrame, low: str, high: str, own: str, levels: Column, side: str) -> DataFrame:
        width = F.pow(F.lit(2.0), F.col("_level")) * unit
        coarser = F.filter(F.col("_levels"), lambda v: v > F.col(own))
        return (
            df.withColumn("_levels", levels)
            .withColumn("_level", F.explode(F.concat(F.array(own), coarser)))
            .withColumn(f"_home_{side}", F.col("_level") == F.col(own))
            .withColumn(f"_first_{side}", F.floor(F.col(low) / width))
            .withColumn("_bucket", F.explode(F.sequence(F.col(f"_first_{side}"), F.floor(F.col(high) / width))))
            .drop("_levels", own)
        )

    a = ranges.where(F.col("low") < F.col("high")).withColumn("_own_a", level("low", "high"))
    # spans shorter than every range, and those of one point, live among the shortest ranges
    shortest = a.agg(F.min("_own_a")).scalar()
    own_b = F.when(F.col("first") < F.col("last"), F.greatest(level("first", "last"), F.col("_shortest"))).otherwise(F.col("_shortest"))
    b = (
        spans.where(F.col("first") <= F.col("last")).withColumn("_shortest", shortest)
        .where(F.col("_shortest").isNotNull()).withColumn("_own_b", own_b).drop("_shortest")
    )
    levels_a = a.agg(F.collect_set("_own_a")).scalar()
    levels_b = b.agg(F.collect_set("_own_b")).scalar()
    pairs = salted_join(
        listed(b, "first", "last", "_own_b", levels_a, "b"),
        listed(a, "low", "high", "_own_a", levels_b, "a"),
        ["_level", "_bucket"], spread_by,
    )
    meets = (
        (F.col("_home_a") | F.col("_home_b"))
        & (F.col("_bucket") == F.greatest("_first_a", "_first_b"))
        & (F.col("first") < F.col("high")) & (F.col("last") >= F.col("low"))
    )
    return pairs.where(meets).drop("_level", "_bucket", "_home_a", "_home_b", "_first_a", "_first_b")


# --- extents, tiles and clusters ---------------------------------------------------

def extent(points: DataFrame, keys: list[str], lat: str = "lat", lon: str = "lon", into: str = "box") -> DataFrame:
    """Bounding box of the points of each key."""
    return points.groupBy(*keys).agg(
        geo.box(F.min(lat), F.min(lon), F.max(lat), F.max(lon)).alias(into)
    )


def cover_with_tiles(boxes: DataFrame, x0: str, y0: str, x1: str, y1: str, size: float = TILE_PIXELS) -> DataFrame:
    """One row per tile that covers a pixel box."""
    return boxes.withColumn("tile_x", F.explode(geo.tiles_over(x0, x1, size))).withColumn(
        "tile_y", F.explode(geo.tiles_over(y0, y1, size))
    )


def cluster_points(points: DataFrame, zoom: int, keys: list[str] | None = None, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Points counted and averaged per tile."""
    tile = geo.tile_index(lat, lon, zoom)
    return (
        points.withColumn("_t", tile)
        .withColumns({"tile_x": F.col("_t.x"), "tile_y": F.col("_t.y")})
        .groupBy(*(keys or []), "tile_x", "tile_y")
        .agg(F.count(F.lit(1)).alias("points"), F.avg(lat).alias("lat"), F.avg(lon).alias("lon"))
    )


# --- cell grids ----------------------------------------------------------------------

def pyramid_depth(width: int, height: int) -> int:
    """Index of the smallest level: halving goes on until a side is shorter than 2."""
    return max(0, (min(width, height) - 1).bit_length())


def pyramid(cells: DataFrame, width: int, height: int, x: str = "x", y: str = "y", value: str = "value") -> DataFrame:
    """Cell sums of every level of a zoom pyramid.

    Base cells are summed first; each then adds to all its levels in one more shuffle.
    """
    base = cells.groupBy(x, y).agg(F.sum(value).alias(value))
    levels = F.sequence(F.lit(0), F.lit(pyramid_depth(width, height)))
    return (
        base.withColumn("level", F.explode(levels))
        .withColumns({
            x: F.floor(F.col(x) / F.pow(F.lit(2.0), F.col("level"))),
            y: F.floor(F.col(y) / F.pow(F.lit(2.0), F.col("level"))),
        })
        .groupBy("level", x, y)
        .agg(F.sum(value).alias(value))
    )


def best_level(width: Column, height: Column, want_width: Column, want_height: Column) -> Column:
    """Smallest pyramid level that is still at least as large as wanted; 0 if none is."""
    def side(full: Column, level: Column) -> Column:
        return F.ceil(full / F.pow(F.lit(2.0), level))

    def usable(level: Column) -> Column:
        above = level - 1
        exists = (level == 0) | ((side(width, above) >= 2) & (side(height, above) >= 2))
        return exists & (side(width, level) >= want_width) & (side(height, level) >= want_height)

    deepest = F.ceil(F.log2(F.greatest(width, height, F.lit(1)).cast("double"))).cast("int")
    fits = F.filter(F.sequence(F.lit(0), deepest), usable)
    return F.coalesce(F.array_max(fits), F.lit(0))


def resample_cells(cells: DataFrame, images: DataFrame, zoom: int) -> DataFrame:
    """Place the cells of georeferenced grids into map tiles (nearest neighbour).

    ``cells``: image, row, col, value. ``images``: image, box, w, h. Gives one row per
    cell and tile it shows in, with pixel position and size inside the tile. Blocks of an
    image are keys of their own, so a large image is spread over tasks.
    """
    placed = images.withColumns({
        "_tl": geo.tile_xy(F.col("box.north"), F.col("box.west"), zoom),
        "_br": geo.tile_xy(F.col("box.south"), F.col("box.east"), zoom),
    })
    block = lambda c: F.floor(F.col(c) / IMAGE_BLOCK)
    blocks = placed
    for name, count in (("_brow", "h"), ("_bcol", "w")):
        blocks = blocks.withColumn(name, F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / IMAGE_BLOCK))))
    df = cells.withColumns({"_brow": block("row"), "_bcol": block("col")}).join(blocks, ["image", "_brow", "_bcol"]).drop("_brow", "_bcol")
    for axis, position, count in (("x", "col", "w"), ("y", "row", "h")):
        start, stop = F.col(f"_tl.{axis}"), F.col(f"_br.{axis}")
        res, n, i = F.col(f"_r{axis}"), F.col(count), F.col(position)
        tile = F.col(f"tile_{axis}")
        # one tile of slack on each side; the exact window test follows
        reach = F.sequence(F.floor(start + i / res) - 1, F.floor(start + (i + 1) / res) + 1)
        df = df.withColumn(f"_r{axis}", n / (stop - start)).withColumn(f"tile_{axis}", F.explode(reach))
        first = F.greatest(F.lit(0), F.floor((tile - start) * res))
        last = F.least(n, F.ceil((tile + 1 - start) * res))
        df = df.where((start < tile + 1) & (stop >= tile) & (i >= first) & (i < last))
        at = (i / res + start - tile) * TILE_PIXELS
        begin, end = F.floor(at + 0.5), F.floor(at + TILE_PIXELS / res + 0.5)
        df = df.withColumns({f"pixel_{axis}": begin, f"size_{axis}": end - begin})
    return df.select(
        "image", "row", "col", "value", "tile_x", "tile_y", "pixel_x", "pixel_y", "size_x", "size_y"
    )


# --- lines ---------------------------------------------------------------------------

def nearest_on_line(px: Column, py: Column, line: Column | str) -> Column:
    """Closest point of a line to a point, over all its segments, with the distance."""
    steps = shapes.line_steps(line)
    per_step = F.transform(
        steps, lambda s: geo.nearest_on_segment(px, py, s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"])
    )
    ranked = F.transform(per_step, lambda n: F.struct(n["distance"].alias("distance"), n["x"].alias("x"), n["y"].alias("y")))
    return F.array_min(ranked)


def _kept_vertices(x: np.ndarray, y: np.ndarray, tolerance2: float) -> list[int]:
    """Positions left after thinning by distance and then by deviation from chords."""
    if len(x) < 3 or tolerance2 <= 0:
        return list(range(len(x)))
    thin = [0]
    for i in range(1, len(x)):
        if (x[i] - x[thin[-1]]) ** 2 + (y[i] - y[thin[-1]]) ** 2 > tolerance2:
            thin.append(i)
    if thin[-1] != len(x) - 1:
        thin.append(len(x) - 1)
    keep, todo = {thin[0], thin[-1]}, [(0, len(thin) - 1)]
    tx, ty = x[thin], y[thin]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2:
            continue
        dx, dy = tx[hi] - tx[lo], ty[hi] - ty[lo]
        px, py = tx[lo + 1:hi] - tx[lo], ty[lo + 1:hi] - ty[lo]
        length2 = dx * dx + dy * dy
        along = np.clip((px * dx + py * dy) / length2, 0, 1) if length2 > 0 else np.zeros(len(px))
        off = (px - along * dx) ** 2 + (py - along * dy) ** 2
        far = int(np.argmax(off))
        if off[far] > tolerance2:
            mid = lo + 1 + far
            keep.add(thin[mid])
            todo += [(lo, mid), (mid, hi)]
    return sorted(keep)


def simplify_lines(lines: DataFrame, line: str, tolerance: float, into: str) -> DataFrame:
    """Simplify each line feature; end points stay. One feature is one row."""

    @F.pandas_udf("array<int>")
    def kept(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([_kept_vertices(np.asarray(x), np.asarray(y), tolerance**2) for x, y in zip(xs, ys)])

    positions = kept(F.transform(line, lambda v: v["x"]), F.transform(line, lambda v: v["y"]))
    return lines.withColumn("_kept", positions).withColumn(
        into, F.transform("_kept", lambda i: F.get(F.col(line), i))
    ).drop("_kept")
