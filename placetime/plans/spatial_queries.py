"""Spatial joins, clusters, pyramids, line and polygon work."""

from __future__ import annotations

from pyspark.sql import functions as F

from placetime.functions import geo, shapes
from placetime.operators import lines, spatial
from placetime.operators.keyed import latest_per_key
from placetime.plans.fixtures import (
    BOXES_SQL, EXTENTS_SQL, NUMBERED_SQL, POINTS_SQL, POLYGON_SIDES_SQL, boxes, extents, points, polygons, tracks,
)
from placetime.plans.geo_queries import tile_sql
from placetime.plans.registry import query, r6, table


@query(f"""
WITH {POINTS_SQL}, {BOXES_SQL}
SELECT box_id, event_type, user_id, count(*) AS points FROM points JOIN boxes
  ON lat BETWEEN south AND north AND lon BETWEEN west AND east
GROUP BY ALL
""")
def brushed_keys(spark, sf):
    chosen = spatial.brush(points(spark, sf), boxes(spark, sf), "event_type", "user_id", "box_id")
    return chosen.groupBy("box_id", "event_type", "user_id").agg(F.count(F.lit(1)).alias("points"))


@query("""
WITH ranges AS (SELECT n_nationkey AS range_id, 900e0 + n_nationkey * 70 AS low, 900e0 + n_nationkey * 70 + 3 * (n_nationkey + 1) AS high FROM nation),
spans AS (SELECT p_partkey AS span_id, p_retailprice AS first, p_retailprice + p_size AS last FROM part)
SELECT range_id, span_id FROM ranges JOIN spans ON first < high AND last >= low
""")
def overlapping_intervals(spark, sf):
    n = F.col("n_nationkey")
    low = 900.0 + n * 70
    ranges = table(spark, sf, "nation").select(n.alias("range_id"), low.alias("low"), (low + 3 * (n + 1)).alias("high"))
    spans = table(spark, sf, "part").select(
        F.col("p_partkey").alias("span_id"), F.col("p_retailprice").alias("first"), (F.col("p_retailprice") + F.col("p_size")).alias("last")
    )
    return spatial.overlapping_intervals(ranges, spans, spread_by=["span_id"]).select("range_id", "span_id")


@query(f"""
WITH {POINTS_SQL}, {BOXES_SQL}, {POLYGON_SIDES_SQL}
SELECT event_id, box_id, kind FROM points JOIN sides
  ON (ay > lat) <> (b_y > lat) AND lon < (bx - ax) * (lat - ay) / (b_y - ay) + ax
GROUP BY event_id, box_id, kind HAVING count(*) % 2 = 1
""")
def points_in_polygons(spark, sf):
    found = spatial.points_in_polygons(points(spark, sf), polygons(spark, sf))
    return found.select("event_id", "box_id", "kind")


@query(f"""
WITH {POINTS_SQL}, {BOXES_SQL}, circles AS (
  SELECT box_id, south AS clat, west AS clon, 40000e0 + 8000 * box_id AS radius FROM boxes
), a AS (
  SELECT event_id, box_id, radius, pow(sin(radians(clat - lat) / 2), 2)
         + cos(radians(lat)) * cos(radians(clat)) * pow(sin(radians(clon - lon) / 2), 2) AS a FROM points, circles
)
SELECT event_id, box_id, round(2 * 6371000e0 * atan2(sqrt(a), sqrt(1 - a)), 3) AS distance FROM a
WHERE 2 * 6371000e0 * atan2(sqrt(a), sqrt(1 - a)) <= radius
""")
def points_within_radius(spark, sf):
    circles = boxes(spark, sf).select(
        "box_id", F.col("box.south").alias("clat"), F.col("box.west").alias("clon"), (40000.0 + 8000 * F.col("box_id")).alias("radius")
    )
    near = spatial.points_within(points(spark, sf), circles, spread_by=["event_id"])
    return near.select("event_id", "box_id", r6("distance", digits=3).alias("distance"))


@query(f"""
WITH {POINTS_SQL}, latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM points) WHERE rn = 1
), {tile_sql(5).replace("FROM points", "FROM latest")}
SELECT tile_x, tile_y, count(*) AS points, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon FROM tiled GROUP BY 1, 2
""")
def clustered_points(spark, sf):
    latest = latest_per_key(points(spark, sf), ["event_type", "user_id"], ["ts", "event_id"])
    return spatial.cluster_points(latest, 5).withColumns({"lat": r6("lat"), "lon": r6("lon")})


_GRID_W, _GRID_H = 50, 20


def _grid(spark, sf):
    return points(spark, sf).select(
        "event_type", F.floor((F.col("lon") + 125) / 58 * _GRID_W).alias("x"),
        F.floor((F.col("lat") - 24.5) / 25 * _GRID_H).alias("y"), F.lit(1).alias("value"),
    )


_GRID_SQL = f"""
grid AS (
  SELECT event_type, CAST(floor((lon + 125) / 58 * {_GRID_W}) AS BIGINT) AS x,
         CAST(floor((lat - 24.5e0) / 25 * {_GRID_H}) AS BIGINT) AS y FROM points)"""


@query(f"""
WITH {POINTS_SQL}, {_GRID_SQL}
SELECT CAST(level AS INTEGER) AS level, x // CAST(pow(2, level) AS BIGINT) AS x, y // CAST(pow(2, level) AS BIGINT) AS y, count(*) AS value
FROM grid, range({spatial.pyramid_depth(_GRID_W, _GRID_H) + 1}) AS l(level) GROUP BY ALL
""")
def zoom_pyramid(spark, sf):
    return spatial.pyramid(_grid(spark, sf), _GRID_W, _GRID_H)


@query("""
WITH sizes AS (SELECT p_partkey, p_size * 20 AS w, p_size * 13 AS h FROM part),
levels AS (SELECT *, ceil(w / pow(2, level)) AS lw, ceil(h / pow(2, level)) AS lh,
           ceil(w / pow(2, level - 1)) AS pw, ceil(h / pow(2, level - 1)) AS ph FROM sizes, range(12) AS l(level))
SELECT p_partkey, CAST(coalesce(max(level) FILTER (WHERE (level = 0 OR (pw >= 2 AND ph >= 2)) AND lw >= 90 AND lh >= 45), 0) AS INTEGER) AS level
FROM levels GROUP BY 1
""")
def pyramid_levels(spark, sf):
    level = spatial.best_level(F.col("p_size") * 20, F.col("p_size") * 13, F.lit(90), F.lit(45))
    return table(spark, sf, "part").select("p_partkey", level.alias("level"))


_ZOOM = 4
_TILE_SQL = f"""
images AS (
  SELECT (-125e0 + 180) / 360 * {2**_ZOOM} AS tlx, (-67e0 + 180) / 360 * {2**_ZOOM} AS brx,
         (1 - ln(tan(radians(49.5e0)) + 1 / cos(radians(49.5e0))) / pi()) / 2 * {2**_ZOOM} AS tly,
         (1 - ln(tan(radians(24.5e0)) + 1 / cos(radians(24.5e0))) / pi()) / 2 * {2**_ZOOM} AS bry
), scaled AS (SELECT *, {_GRID_W} / (brx - tlx) AS rx, {_GRID_H} / (bry - tly) AS ry FROM images)"""


@query(f"""
WITH {POINTS_SQL}, {_GRID_SQL}, {_TILE_SQL}, cells AS (
  SELECT event_type AS image, {_GRID_H} - 1 - y AS "row", x AS col, count(*) AS value FROM grid GROUP BY ALL
), placed AS (
  SELECT *, (col / rx + tlx - tile_x) * 256 AS px, (row / ry + tly - tile_y) * 256 AS py
  FROM cells, scaled, range({2**_ZOOM}) AS a(tile_x), range({2**_ZOOM}) AS b(tile_y)
  WHERE tlx < tile_x + 1 AND brx >= tile_x AND tly < tile_y + 1 AND bry >= tile_y
    AND col >= greatest(0, floor((tile_x - tlx) * rx)) AND col < least({_GRID_W}, ceil((tile_x + 1 - tlx) * rx))
    AND row >= greatest(0, floor((tile_y - tly) * ry)) AND row < least({_GRID_H}, ceil((tile_y + 1 - tly) * ry))
)
SELECT image, row, col, value, tile_x, tile_y, CAST(floor(px + 0.5e0) AS BIGINT) AS pixel_x, CAST(floor(py + 0.5e0) AS BIGINT) AS pixel_y,
       CAST(floor(px + 256 / rx + 0.5e0) - floor(px + 0.5e0) AS BIGINT) AS size_x,
       CAST(floor(py + 256 / ry + 0.5e0) - floor(py + 0.5e0) AS BIGINT) AS size_y FROM placed
""")
def resampled_cells(spark, sf):
    # rows of an image count from the north
    row = (_GRID_H - 1 - F.col("y")).alias("row")
    cells = _grid(spark, sf).groupBy(F.col("event_type").alias("image"), row, F.col("x").alias("col")).agg(F.sum("value").alias("value"))
    images = cells.select("image").distinct().withColumns({
        "box": geo.box(24.5, -125.0, 49.5, -67.0), "w": F.lit(_GRID_W), "h": F.lit(_GRID_H),
    })
    return spatial.resample_cells(cells, images, _ZOOM)


# --- lines and rings --------------------------------------------------------------

_STEPS_SQL = f"""
{NUMBERED_SQL}, steps AS (
  SELECT user_id, pos, lon AS bx, lat AS b_y, lag(lon) OVER w AS ax, lag(lat) OVER w AS ay
  FROM tracked WINDOW w AS (PARTITION BY user_id ORDER BY pos)
), lengths AS (
  SELECT *, coalesce(sqrt(pow(bx - ax, 2) + pow(b_y - ay, 2)), 0e0) AS d FROM steps
), runs AS (
  SELECT *, sum(d) OVER (PARTITION BY user_id ORDER BY pos) AS gone, sum(d) OVER (PARTITION BY user_id) AS total FROM lengths)"""


@query(f"""
WITH {POINTS_SQL}, {_STEPS_SQL}, firsts AS (
  SELECT user_id, min_by(bx, pos) AS fx, min_by(b_y, pos) AS fy, max(total) AS total FROM runs GROUP BY 1
), mids AS (
  SELECT user_id, min_by(bx - (gone - total / 2) / d * (bx - ax), pos) AS mx, min_by(b_y - (gone - total / 2) / d * (b_y - ay), pos) AS my
  FROM runs WHERE gone > total / 2 AND d > 0 GROUP BY 1
)
SELECT user_id, round(total, 6) AS length, round(coalesce(mx, fx), 6) AS x, round(coalesce(my, fy), 6) AS y
FROM firsts LEFT JOIN mids USING (user_id)
""".replace("min_by(", "arg_min("))
def line_midpoints(spark, sf):
    found = lines.line_measures(points(spark, sf), ["user_id"], ["ts", "event_id"], "lon", "lat")
    return found.select("user_id", r6("length").alias("length"), r6("x").alias("x"), r6("y").alias("y"))


@query(f"""
WITH {POINTS_SQL}, {_STEPS_SQL}, near AS (
  SELECT user_id, ax, ay, bx - ax AS dx, b_y - ay AS dy FROM steps WHERE ax IS NOT NULL
), k AS (
  SELECT *, CASE WHEN dx * dx + dy * dy > 0 THEN
    greatest(0e0, least(1e0, ((-95e0 - ax) * dx + (37e0 - ay) * dy) / (dx * dx + dy * dy))) ELSE 0e0 END AS k FROM near
)
SELECT user_id, round(min(sqrt(pow(-95e0 - (ax + dx * k), 2) + pow(37e0 - (ay + dy * k), 2))), 6) AS distance FROM k GROUP BY 1
""")
def nearest_on_lines(spark, sf):
    steps = lines.segments(points(spark, sf), ["user_id"], ["ts", "event_id"], "lon", "lat")
    return lines.nearest_to(steps, ["user_id"], -95.0, 37.0).select("user_id", r6("distance").alias("distance"))


@query(f"""
WITH {POINTS_SQL}, {EXTENTS_SQL}, zigzags AS (
  SELECT user_id, 0 AS part, west AS ax, south AS ay, (west + east) / 2 AS bx, north AS b_y FROM extents
  UNION ALL SELECT user_id, 1, (west + east) / 2, north, east, south FROM extents
), along AS (
  SELECT event_id, z.user_id, part, lon, lat, ax, ay, bx - ax AS dx, b_y - ay AS dy,
    CASE WHEN pow(bx - ax, 2) + pow(b_y - ay, 2) > 0 THEN greatest(0e0, least(1e0,
      ((lon - ax) * (bx - ax) + (lat - ay) * (b_y - ay)) / (pow(bx - ax, 2) + pow(b_y - ay, 2)))) ELSE 0e0 END AS k
  FROM points, zigzags z
), met AS (
  SELECT event_id, user_id, part, ax + dx * k AS x, ay + dy * k AS y, sqrt(pow(lon - ax - dx * k, 2) + pow(lat - ay - dy * k, 2)) AS distance FROM along
)
SELECT event_id, first(user_id ORDER BY distance, user_id, part) AS nearest, round(min(distance), 6) AS distance,
       round(first(x ORDER BY distance, user_id, part), 5) AS x, round(first(y ORDER BY distance, user_id, part), 5) AS y
FROM met GROUP BY event_id
""")
def nearest_line_points(spark, sf):
    """For every event the nearest of the lines that zigzag through the extents of the users."""
    b, middle = F.col("box"), (F.col("box.west") + F.col("box.east")) / 2
    part = lambda n, ax, ay, bx, by: F.struct(F.lit(n).alias("part"), ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"))
    zigzags = extents(spark, sf).select("user_id", F.inline(F.array(
        part(0, b["west"], b["south"], middle, b["north"]), part(1, middle, b["north"], b["east"], b["south"]),
    )))
    found = lines.nearest_lines(points(spark, sf), zigzags, ["event_id"], ["user_id", "part"], "lon", "lat")
    return found.select(
        "event_id", F.col("user_id").alias("nearest"), r6("distance").alias("distance"),
        r6("near_x", digits=5).alias("x"), r6("near_y", digits=5).alias("y"),
    )


_RING_SIDES_SQL = """
ringed AS (SELECT user_id, pos, lon AS x, lat AS y FROM tracked)"""


@query(f"""
WITH {POINTS_SQL}, {NUMBERED_SQL}, {_RING_SIDES_SQL}, sides AS (
  SELECT user_id, pos, x AS bx, y AS b_y,
         coalesce(lag(x) OVER w, last_value(x) OVER f) AS ax, coalesce(lag(y) OVER w, last_value(y) OVER f) AS ay
  FROM ringed WINDOW w AS (PARTITION BY user_id ORDER BY pos),
    f AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), sums AS (
  SELECT user_id, sum((ax + bx) * (ay * bx - b_y * ax)) AS sx, sum((ay + b_y) * (ay * bx - b_y * ax)) AS sy,
         sum(3 * (ay * bx - b_y * ax)) AS area, sum(abs(ay * bx - b_y * ax)) AS size FROM sides GROUP BY 1
)
SELECT s.user_id, round(CASE WHEN abs(area) > 3e-12 * size THEN sx / area ELSE fx END, 3) AS x,
       round(CASE WHEN abs(area) > 3e-12 * size THEN sy / area ELSE fy END, 3) AS y FROM sums s
JOIN (SELECT user_id, arg_min(x, pos) AS fx, arg_min(y, pos) AS fy FROM ringed GROUP BY 1) f ON f.user_id = s.user_id
""")
def ring_centroids(spark, sf):
    """Tracks taken as rings; those without area give their first vertex."""
    found = lines.ring_centroids(points(spark, sf), ["user_id"], ["ts", "event_id"], "lon", "lat")
    return found.select("user_id", r6("x", digits=3).alias("x"), r6("y", digits=3).alias("y"))


def _clip_sql() -> str:
    """One stage per box side: cut points and kept vertices, in ring order."""
    stages, source = [], "ringed"
    for number, (axis, limit, op) in enumerate((("x", -110, ">="), ("x", -80, "<="), ("y", 30, ">="), ("y", 42, "<="))):
        other = "y" if axis == "x" else "x"
        cut = f"{'p' + other} + ({other} - p{other}) * (({limit}e0 - p{axis}) / ({axis} - p{axis}))"
        x, y = (f"{limit}e0", cut) if axis == "x" else (cut, f"{limit}e0")
        stages.append(f"""
pairs{number} AS (
  SELECT *, coalesce(lag(x) OVER w, last_value(x) OVER f) AS px, coalesce(lag(y) OVER w, last_value(y) OVER f) AS py
  FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY pos),
    f AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), kept{number} AS (
  SELECT user_id, pos * 2 + 1 AS pos, x, y FROM pairs{number} WHERE {axis} {op} {limit}
  UNION ALL
  SELECT user_id, pos * 2, {x}, {y} FROM pairs{number} WHERE ({axis} {op} {limit}) <> (p{axis} {op} {limit})
)""")
        source = f"kept{number}"
    return ",".join(stages)


@query(f"""
WITH {POINTS_SQL}, {NUMBERED_SQL}, {_RING_SIDES_SQL}, {_clip_sql()}
SELECT user_id, count(*) AS vertices, round(sum(x), 4) AS x_sum, round(sum(y), 4) AS y_sum FROM kept3 GROUP BY 1
""")
def clipped_rings(spark, sf):
    rings = tracks(spark, sf).withColumn("box", geo.box(30.0, -110.0, 42.0, -80.0))
    clipped = shapes.clip_rings(rings, "line", "box", "clipped").where(F.size("clipped") > 0)

    def total(axis):
        return F.aggregate("clipped", F.lit(0.0), lambda acc, v: acc + v[axis])

    return clipped.select(
        "user_id", F.size("clipped").cast("bigint").alias("vertices"),
        r6(total("x"), digits=4).alias("x_sum"), r6(total("y"), digits=4).alias("y_sum"),
    )


_TOLERANCE = 8.0


@query(f"""
WITH RECURSIVE {POINTS_SQL}, {NUMBERED_SQL}, verts AS (
  SELECT user_id, pos, lon AS x, lat AS y, max(pos) OVER (PARTITION BY user_id) AS last,
         min(pos) OVER (PARTITION BY user_id) AS first FROM tracked
), hops AS (
  SELECT a.user_id, a.pos, min(b.pos) AS next FROM verts a JOIN verts b
    ON a.user_id = b.user_id AND b.pos > a.pos
   AND pow(b.x - a.x, 2) + pow(b.y - a.y, 2) > {_TOLERANCE**2} GROUP BY 1, 2
), thin AS (
  SELECT user_id, pos FROM verts WHERE pos = first
  UNION ALL SELECT t.user_id, h.next FROM thin t JOIN hops h ON t.user_id = h.user_id AND t.pos = h.pos
), left_over AS (
  SELECT user_id, pos, x, y, first, last FROM verts WHERE pos = last OR (user_id, pos) IN (SELECT (user_id, pos) FROM thin)
), spans AS (
  SELECT DISTINCT user_id, first AS lo, last AS hi FROM verts WHERE last > first
  UNION ALL
  SELECT user_id, unnest([lo, far]) AS lo, unnest([far, hi]) AS hi FROM (
    SELECT user_id, lo, hi, arg_max(pos, off) AS far, max(off) AS off FROM (
      SELECT s.user_id, s.lo, s.hi, v.pos,
             pow(v.x - a.x - k * (b.x - a.x), 2) + pow(v.y - a.y - k * (b.y - a.y), 2) AS off
      FROM (
        SELECT s.*, v.pos, greatest(0e0, least(1e0, ((v.x - a.x) * (b.x - a.x) + (v.y - a.y) * (b.y - a.y))
                 / nullif(pow(b.x - a.x, 2) + pow(b.y - a.y, 2), 0))) AS k
        FROM spans s JOIN left_over v ON v.user_id = s.user_id AND v.pos > s.lo AND v.pos < s.hi
        JOIN left_over a ON a.user_id = s.user_id AND a.pos = s.lo
        JOIN left_over b ON b.user_id = s.user_id AND b.pos = s.hi) s
      JOIN left_over v ON v.user_id = s.user_id AND v.pos = s.pos
      JOIN left_over a ON a.user_id = s.user_id AND a.pos = s.lo
      JOIN left_over b ON b.user_id = s.user_id AND b.pos = s.hi
    ) GROUP BY user_id, lo, hi
  ) WHERE off > {_TOLERANCE**2}
), kept AS (
  SELECT user_id, lo AS pos FROM spans UNION SELECT user_id, hi FROM spans
  UNION SELECT user_id, first FROM verts
)
SELECT user_id, count(*) AS before, count(k.pos) AS after,
       round(sum(CASE WHEN k.pos IS NOT NULL THEN x END), 6) AS x_sum
FROM verts LEFT JOIN kept k USING (user_id, pos) GROUP BY 1
""")
def simplified_lines(spark, sf):
    kept = spatial.simplify_lines(tracks(spark, sf), "line", _TOLERANCE, "simple")
    x_sum = F.aggregate("simple", F.lit(0.0), lambda acc, v: acc + v["x"])
    return kept.select(
        "user_id", F.size("line").cast("bigint").alias("before"), F.size("simple").cast("bigint").alias("after"),
        r6(x_sum).alias("x_sum"),
    )
