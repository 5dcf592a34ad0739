"""Projections, tiles, boxes, segments and GeoJSON over points derived from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from placetime.functions import geo, shapes
from placetime.operators import spatial
from placetime.operators.ordered import ordered_columns
from placetime.plans.fixtures import (
    BOXES_SQL, EXTENTS_SQL, NUMBERED_SQL, POINTS_SQL, POLYGON_SIDES_SQL, boxes, extents, numbered_points, points, polygons,
)
from placetime.plans.registry import query, r6
from placetime.session import fresh_path
from placetime.sources import geojson

_R, _RM, _B = 6371000.0, 6378137.0, 6356752.314245179
_E = "sqrt(1 - (6356752.314245179e0 / 6378137e0) * (6356752.314245179e0 / 6378137e0))"


def _xy(column, scale=1.0, digits=6):
    return [r6(F.col(column)[axis], scale, digits).alias(axis) for axis in ("x", "y")]


@query(f"""
WITH {POINTS_SQL}, a AS (
  SELECT event_id, pow(sin(radians(39.5e0 - lat) / 2), 2)
         + cos(radians(lat)) * cos(radians(39.5e0)) * pow(sin(radians(-103.5e0 - lon) / 2), 2) AS a FROM points)
SELECT event_id, round(2 * 6371000e0 * atan2(sqrt(a), sqrt(1 - a)), 4) AS metres FROM a
""")
def great_circle_distance(spark, sf):
    metres = geo.great_circle("lat", "lon", 39.5, -103.5)
    return points(spark, sf).select("event_id", r6(metres, digits=4).alias("metres"))


_MERCATOR_SQL = """
mercator AS (
  SELECT *, 6378137e0 * radians(lon) AS mx,
         6378137e0 * ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) / 2 AS my FROM points)"""


@query(f"WITH {POINTS_SQL}, {_MERCATOR_SQL} SELECT event_id, round(mx, 4) AS x, round(my, 4) AS y FROM mercator")
def web_mercator(spark, sf):
    return points(spark, sf).withColumn("p", geo.mercator_xy("lat", "lon")).select("event_id", *_xy("p", digits=4))


@query(f"WITH {POINTS_SQL} SELECT event_id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM points")
def web_mercator_inverse(spark, sf):
    there = points(spark, sf).withColumn("p", geo.mercator_xy("lat", "lon"))
    back = there.withColumn("q", geo.mercator_latlon("p.x", "p.y"))
    return back.select("event_id", r6("q.lat").alias("lat"), r6("q.lon").alias("lon"))


_ELLIPSOID_SQL = f"""
ellipsoid AS (
  SELECT *, 6378137e0 * radians(lon) AS ex,
         -6378137e0 * ln(greatest(tan(pi() / 4 - radians(lat) / 2)
           / pow((1 - {_E} * sin(radians(lat))) / (1 + {_E} * sin(radians(lat))), {_E} / 2), 1e-10)) AS ey FROM points)"""


@query(f"WITH {POINTS_SQL}, {_ELLIPSOID_SQL} SELECT event_id, round(ex, 4) AS x, round(ey, 4) AS y FROM ellipsoid")
def ellipsoid_mercator(spark, sf):
    return points(spark, sf).withColumn("p", geo.ellipsoid_xy("lat", "lon")).select("event_id", *_xy("p", digits=4))


_START_SQL = "SELECT event_id, ex, exp(-ey / 6378137e0) AS r, pi() / 2 - 2 * atan(exp(-ey / 6378137e0)) AS phi, 0.1e0 AS step FROM ellipsoid"
_ROUNDS_SQL = ", ".join(
    [f"round0 AS ({_START_SQL})"] + [
        f"""round{i} AS (SELECT event_id, ex, r, CASE WHEN abs(step) > 1e-7 THEN better ELSE phi END AS phi,
              CASE WHEN abs(step) > 1e-7 THEN better - phi ELSE step END AS step
            FROM (SELECT *, pi() / 2 - 2 * atan(r * pow((1 - {_E} * sin(phi)) / (1 + {_E} * sin(phi)), {_E} / 2)) AS better
                  FROM round{i - 1}))"""
        for i in range(1, 16)
    ]
)


@query(f"""
WITH {POINTS_SQL}, {_ELLIPSOID_SQL}, {_ROUNDS_SQL}
SELECT event_id, round(degrees(phi), 6) AS lat, round(degrees(ex / 6378137e0), 6) AS lon FROM round15
""")
def ellipsoid_mercator_inverse(spark, sf):
    there = points(spark, sf).withColumn("p", geo.ellipsoid_xy("lat", "lon"))
    back = there.withColumn("q", geo.ellipsoid_latlon("p.x", "p.y"))
    return back.select("event_id", r6("q.lat").alias("lat"), r6("q.lon").alias("lon"))


@query(f"""
WITH {POINTS_SQL}, {_MERCATOR_SQL}, z AS (SELECT *, event_id % 19 AS zoom FROM mercator)
SELECT event_id, '3857' AS crs, round((mx * (0.5e0 / (pi() * 6378137e0)) + 0.5e0) * 256 * pow(2, zoom), 3) AS x,
       round((my * (-0.5e0 / (pi() * 6378137e0)) + 0.5e0) * 256 * pow(2, zoom), 3) AS y FROM z
UNION ALL SELECT event_id, '4326', round((lon / 180 + 1) * 256 * pow(2, zoom), 3), round((lat / -180 + 0.5e0) * 256 * pow(2, zoom), 3) FROM z
UNION ALL SELECT event_id, 'Simple', round(lon * pow(2, zoom), 3), round(-lat * pow(2, zoom), 3) FROM z
""")
def pixel_positions(spark, sf):
    zoomed = points(spark, sf).withColumn("zoom", F.col("event_id") % 19)
    both = F.array(*(
        F.struct(F.lit(name).alias("crs"), geo.pixel_position("lat", "lon", "zoom", code).alias("p"))
        for name, code in (("3857", "EPSG:3857"), ("4326", "EPSG:4326"), ("Simple", "Simple"))
    ))
    return zoomed.select("event_id", F.inline(both)).select("event_id", "crs", *_xy("p", digits=3))


@query(f"""
WITH {POINTS_SQL}, {_ELLIPSOID_SQL}
SELECT event_id, round((ex * (0.5e0 / (pi() * 6378137e0)) + 0.5e0) * 4096, 4) AS x,
       round((ey * (-0.5e0 / (pi() * 6378137e0)) + 0.5e0) * 4096, 4) AS y FROM ellipsoid
""")
def ellipsoid_pixel_positions(spark, sf):
    placed = points(spark, sf).withColumn("p", geo.pixel_position("lat", "lon", 4, "EPSG:3395"))
    return placed.select("event_id", *_xy("p", digits=4))


def tile_sql(zoom: int) -> str:
    return f"""tiled AS (
  SELECT *, CAST(floor((lon + 180) / 360 * {2**zoom}) AS BIGINT) AS tile_x,
         CAST(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * {2**zoom}) AS BIGINT) AS tile_y FROM points)"""


@query(f"WITH {POINTS_SQL}, {tile_sql(6)} SELECT event_id, concat(tile_x, ':', tile_y, ':6') AS tile FROM tiled")
def tile_addresses(spark, sf):
    placed = points(spark, sf).withColumn("t", geo.tile_index("lat", "lon", 6))
    return placed.select("event_id", geo.tile_key("t.x", "t.y", 6).alias("tile"))


@query(f"""
WITH {POINTS_SQL}, far AS (SELECT event_id, lon * 7 AS lng FROM points)
SELECT event_id, round(lng, 6) AS lng, round(lng - 360 * floor((lng + 180) / 360), 6) AS wrapped FROM far
""")
def wrapped_longitudes(spark, sf):
    far = points(spark, sf).select("event_id", (F.col("lon") * 7).alias("lng"))
    return far.select("event_id", r6("lng").alias("lng"), r6(geo.wrap_longitude("lng")).alias("wrapped"))


@query(f"WITH {POINTS_SQL}, {EXTENTS_SQL} SELECT * FROM extents")
def point_extents(spark, sf):
    return extents(spark, sf).select("user_id", "box.*")


@query(f"""
WITH {POINTS_SQL}, {EXTENTS_SQL}
SELECT user_id, concat(CAST(west AS VARCHAR), ',', CAST(south AS VARCHAR), ',', CAST(east AS VARCHAR), ',', CAST(north AS VARCHAR)) AS bbox,
       round((south + north) / 2, 6) AS centre_lat, round((west + east) / 2, 6) AS centre_lon,
       round(south - (north - south) * 0.1e0, 6) AS padded_south, round(east + (east - west) * 0.1e0, 6) AS padded_east,
       37e0 BETWEEN south AND north AND -95e0 BETWEEN west AND east AS has_point,
       30e0 >= south AND 45e0 <= north AND -110e0 >= west AND -70e0 <= east AS has_box,
       north >= 49.4e0 AND south <= 60e0 AND east >= -130e0 AND west <= -60e0 AS meets,
       north > 49.4e0 AND south < 60e0 AND east > -130e0 AND west < -60e0 AS overlaps
FROM extents
""")
def box_tests(spark, sf):
    padded = geo.box_pad("box", 0.1)
    centre = geo.box_centre("box")
    inner = geo.box(30.0, -110.0, 45.0, -70.0)
    high = geo.box(49.4, -130.0, 60.0, -60.0)
    return extents(spark, sf).select(
        "user_id", geo.box_text("box").alias("bbox"),
        r6(centre["lat"]).alias("centre_lat"), r6(centre["lon"]).alias("centre_lon"),
        r6(padded["south"]).alias("padded_south"), r6(padded["east"]).alias("padded_east"),
        geo.box_contains_point("box", 37.0, -95.0).alias("has_point"),
        geo.box_contains("box", inner).alias("has_box"),
        geo.box_intersects("box", high).alias("meets"), geo.box_overlaps("box", high).alias("overlaps"),
    )


_VIEW_SQL = """
padded AS (
  SELECT user_id, day, CASE WHEN south = north THEN south - 0.006e0 ELSE south END AS s,
         CASE WHEN south = north THEN north + 0.006e0 ELSE north END AS n,
         CASE WHEN west = east THEN west - 0.006e0 ELSE west END AS w,
         CASE WHEN west = east THEN east + 0.006e0 ELSE east END AS e FROM daily
), scaled AS (
  SELECT user_id, day, least(
    800 / (256 * (e - w) / 360),
    500 / (256 * (ln((1 + sin(radians(n))) / (1 - sin(radians(n)))) - ln((1 + sin(radians(s))) / (1 - sin(radians(s))))) / (4 * pi()))
  ) AS scale FROM padded)"""


@query(f"""
WITH {POINTS_SQL}, daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, min(lat) AS south, min(lon) AS west, max(lat) AS north, max(lon) AS east
  FROM points GROUP BY 1, 2), {_VIEW_SQL}
SELECT user_id, day, greatest(0e0, least(18e0, floor(floor(log2(scale) * 100 + 0.5e0) / 100))) AS zoom FROM scaled
""")
def fitted_views(spark, sf):
    daily = points(spark, sf).withColumn("day", F.to_date("ts"))
    boxed = spatial.extent(daily, ["user_id", "day"])
    return boxed.select("user_id", "day", geo.view_zoom("box", 800, 500).alias("zoom"))


@query(f"""
WITH {POINTS_SQL}, {EXTENTS_SQL}, corners AS (
  SELECT user_id, (west + 180) / 360 * 8192 AS x0, (east + 180) / 360 * 8192 AS x1,
         (0.5e0 - ln((1 + sin(radians(north))) / (1 - sin(radians(north)))) / (4 * pi())) * 8192 AS y0,
         (0.5e0 - ln((1 + sin(radians(south))) / (1 - sin(radians(south)))) / (4 * pi())) * 8192 AS y1 FROM extents
)
SELECT user_id, tile_x, unnest(range(CAST(floor(y0 / 256) AS BIGINT), CAST(ceil(y1 / 256) AS BIGINT))) AS tile_y
FROM (SELECT *, unnest(range(CAST(floor(x0 / 256) AS BIGINT), CAST(ceil(x1 / 256) AS BIGINT))) AS tile_x FROM corners)
""")
def covering_tiles(spark, sf):
    low = geo.pixel_position("box.north", "box.west", 5)
    high = geo.pixel_position("box.south", "box.east", 5)
    corners = extents(spark, sf).select(
        "user_id", low["x"].alias("x0"), low["y"].alias("y0"), high["x"].alias("x1"), high["y"].alias("y1")
    )
    return spatial.cover_with_tiles(corners, "x0", "y0", "x1", "y1").select("user_id", "tile_x", "tile_y")


_SEGMENTS_SQL = """
segments AS (
  SELECT * FROM (
    SELECT event_id, lon AS x1, lat AS y1, lead(lon) OVER w AS x2, lead(lat) OVER w AS y2 FROM points
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE x2 IS NOT NULL)"""


def _segments(spark, sf):
    """Each point with the next one of the same user."""
    next_ = ordered_columns(
        points(spark, sf), ["user_id"], ["ts", "event_id"], following={"x2": "lon", "y2": "lat"}
    )
    return next_.where(F.col("x2").isNotNull()).select(
        "event_id", F.col("lon").alias("x1"), F.col("lat").alias("y1"), "x2", "y2"
    )


@query(f"""
WITH {POINTS_SQL}, {_SEGMENTS_SQL}, t AS (
  SELECT *, x2 - x1 AS dx, y2 - y1 AS dy FROM segments
), cut AS (
  SELECT *, greatest(0e0, CASE WHEN dx > 0 THEN (-110 - x1) / dx WHEN dx < 0 THEN (-80 - x1) / dx ELSE 0e0 END,
                     CASE WHEN dy > 0 THEN (30 - y1) / dy WHEN dy < 0 THEN (42 - y1) / dy ELSE 0e0 END) AS t0,
         least(1e0, CASE WHEN dx > 0 THEN (-80 - x1) / dx WHEN dx < 0 THEN (-110 - x1) / dx ELSE 1e0 END,
                     CASE WHEN dy > 0 THEN (42 - y1) / dy WHEN dy < 0 THEN (30 - y1) / dy ELSE 1e0 END) AS t1
  FROM t WHERE NOT (dx = 0 AND (x1 < -110 OR x1 > -80)) AND NOT (dy = 0 AND (y1 < 30 OR y1 > 42))
)
SELECT event_id, round(x1 + dx * t0, 6) AS x1, round(y1 + dy * t0, 6) AS y1, round(x1 + dx * t1, 6) AS x2, round(y1 + dy * t1, 6) AS y2
FROM cut WHERE t0 <= t1
""")
def clipped_segments(spark, sf):
    piece = geo.clip_segment("x1", "y1", "x2", "y2", geo.box(30.0, -110.0, 42.0, -80.0))
    clipped = _segments(spark, sf).select("event_id", piece.alias("p")).where(F.col("p").isNotNull())
    return clipped.select("event_id", *(r6(F.col("p")[c]).alias(c) for c in ("x1", "y1", "x2", "y2")))


@query(f"""
WITH {POINTS_SQL}, {_SEGMENTS_SQL}, t AS (
  SELECT *, x2 - x1 AS dx, y2 - y1 AS dy FROM segments
), u AS (
  SELECT *, CASE WHEN dx * dx + dy * dy > 0 THEN
    greatest(0e0, least(1e0, ((-103.5e0 - x1) * dx + (39.5e0 - y1) * dy) / (dx * dx + dy * dy))) ELSE 0e0 END AS k FROM t
)
SELECT event_id, round(x1 + dx * k, 6) AS x, round(y1 + dy * k, 6) AS y,
       round(sqrt(pow(-103.5e0 - (x1 + dx * k), 2) + pow(39.5e0 - (y1 + dy * k), 2)), 6) AS distance FROM u
""")
def nearest_on_segments(spark, sf):
    near = geo.nearest_on_segment(-103.5, 39.5, "x1", "y1", "x2", "y2")
    return _segments(spark, sf).select("event_id", near.alias("n")).select(
        "event_id", *(r6(F.col("n")[c]).alias(c) for c in ("x", "y", "distance"))
    )


@query(f"""
WITH {POINTS_SQL}, b AS (SELECT *, value * 1000 * 180 / 40075017e0 AS up FROM points)
SELECT event_id, round(lat - up, 9) AS south, round(lon - up / cos(radians(lat)), 9) AS west,
       round(lat + up, 9) AS north, round(lon + up / cos(radians(lat)), 9) AS east,
       greatest(abs(0), abs(value * 1e-10)) <= 1e-9 AS same FROM b
""")
def boxes_around_points(spark, sf):
    made = points(spark, sf).withColumn("b", geo.box_around("lat", "lon", F.col("value") * 1000))
    # the second point lies value * 1e-10 degrees east, taken from longitude zero to keep all digits
    same = geo.same_point("lat", 0.0, "lat", F.col("value") * 1e-10)
    return made.select("event_id", *(r6(F.col("b")[c], digits=9).alias(c) for c in ("south", "west", "north", "east")), same.alias("same"))


@query(f"""
WITH {POINTS_SQL}
SELECT event_id, 'Point' AS geometry_type, event_type AS kind, floor(lon * 1e6 + 0.5e0) / 1e6 AS lon, floor(lat * 1e6 + 0.5e0) / 1e6 AS lat
FROM points
""")
def geojson_points(spark, sf):
    properties = F.create_map(F.lit("kind"), F.col("event_type"))
    made = points(spark, sf).select(
        "event_id", geojson.feature("Point", geojson.position(F.col("lon"), F.col("lat")), properties).alias("doc")
    )
    at = geojson.coordinates("Point")
    return geojson.read_features(made, "doc", keep=["event_id"]).select(
        "event_id", "geometry_type", F.col("properties")["kind"].alias("kind"), at[0].alias("lon"), at[1].alias("lat")
    )


_PART = 64


@query(f"""
WITH {POINTS_SQL}, {NUMBERED_SQL}, parted AS (SELECT *, (pos - 1) // {_PART} AS part FROM numbered)
SELECT user_id, part, event_type, count(*) AS features, round(sum(floor(lon * 1e6 + 0.5e0) / 1e6), 4) AS lon_sum
FROM parted WHERE event_type <> 'error' GROUP BY user_id, part, event_type
""")
def geojson_collections(spark, sf):
    """Collections of up to 64 features, flattened again with a filter and an extra column."""
    properties = F.create_map(F.lit("kind"), F.col("event_type"))
    one = geojson.feature("Point", geojson.position(F.col("lon"), F.col("lat")), properties)
    part = F.floor((F.col("pos") - 1) / _PART).alias("part")
    documents = numbered_points(spark, sf).withColumn("feature", one).groupBy("user_id", part).agg(
        geojson.feature_collection(F.collect_list("feature")).alias("doc")
    )
    flat = geojson.read_features(
        documents, "doc", keep=["user_id", "part"], only=F.col("properties")["kind"] != "error",
        each={"event_type": F.col("properties")["kind"], "lon": geojson.coordinates("Point")[0]},
    )
    return flat.groupBy("user_id", "part", "event_type").agg(
        F.count(F.lit(1)).alias("features"), r6(F.sum("lon"), digits=4).alias("lon_sum")
    )


_DECIMALS_SQL = "floor({} * 1e6 + 0.5e0) / 1e6"


def _rounded_sql(*columns: str) -> str:
    return ", ".join(f"{_DECIMALS_SQL.format(c)} AS {c}" for c in columns)


@query(f"""
WITH {POINTS_SQL}, {EXTENTS_SQL}, {BOXES_SQL}, {POLYGON_SIDES_SQL}, positions AS (
  SELECT 'Point' AS geometry_type, concat('e', event_id) AS name, lon AS x, lat AS y, value AS z FROM points
  UNION ALL SELECT 'LineString', concat('u', user_id), unnest([west, (west + east) / 2, east]), unnest([south, north, south]), NULL FROM extents
  UNION ALL SELECT 'Polygon', concat('b', box_id, kind), v.x, v.y, NULL FROM (
    SELECT box_id, kind, unnest([{{'x': bx, 'y': b_y}}, {{'x': bx, 'y': b_y}}]) AS v, unnest([i = 1, true]) AS used FROM sides) WHERE used
), rounded AS (SELECT geometry_type, name, {_rounded_sql("x", "y", "z")} FROM positions)
SELECT geometry_type, name, count(*) AS positions, round(sum(x), 5) AS x, round(sum(y), 5) AS y, round(sum(z), 5) AS z FROM rounded GROUP BY 1, 2
""")
def geojson_shapes(spark, sf):
    """Points with an altitude, lines and closed polygon rings written as features, one to a line, and read back."""
    name = lambda mark, *columns: F.create_map(F.lit("name"), F.concat(F.lit(mark), *columns))
    b = F.col("box")
    zigzag = F.array(
        shapes.vertex(b["west"], b["south"]), shapes.vertex((b["west"] + b["east"]) / 2, b["north"]), shapes.vertex(b["east"], b["south"])
    )
    features = [
        points(spark, sf).select(geojson.feature("Point", geojson.position(F.col("lon"), F.col("lat"), F.col("value")), name("e", "event_id")).alias("f")),
        extents(spark, sf).select(geojson.feature("LineString", geojson.line_positions(zigzag), name("u", "user_id")).alias("f")),
        polygons(spark, sf).select(geojson.feature("Polygon", F.transform("rings", geojson.ring_positions), name("b", "box_id", "kind")).alias("f")),
    ]
    path = fresh_path(spark, "features")
    geojson.write_features(features[0].union(features[1]).union(features[2]), "f", path)
    read = geojson.read_features(spark.read.text(path), "value")
    kind = F.col("geometry_type")
    every = F.when(kind == "Point", F.array(geojson.coordinates("Point"))).when(kind == "LineString", geojson.coordinates("LineString")).otherwise(
        F.flatten(geojson.coordinates("Polygon"))
    )
    placed = read.select("geometry_type", F.col("properties")["name"].alias("name"), F.explode_outer(every).alias("p"))
    total = lambda i: r6(F.sum(F.get("p", F.lit(i))), digits=5)
    return placed.groupBy("geometry_type", "name").agg(F.count("*").alias("positions"), total(0).alias("x"), total(1).alias("y"), total(2).alias("z"))


_DEEP = 5


@query(f"""
WITH {BOXES_SQL}, nodes AS (
  SELECT box_id, 'Polygon' AS geometry_type, 'frame' AS name, 0 AS k, west AS x FROM boxes UNION ALL SELECT box_id, 'Polygon', 'triangle', 0, west + 0.5e0 FROM boxes
  UNION ALL SELECT box_id, 'Point', 'corner', k, west + k / 8e0 FROM boxes, range(1, {_DEEP + 1}) AS r(k)
  UNION ALL SELECT box_id, 'LineString', 'inside', k, west + k / 4e0 FROM boxes, range(1, 4) AS r(k)
)
SELECT box_id, geometry_type, name, count(*) AS features, round(sum(x), 6) AS x FROM nodes GROUP BY 1, 2, 3
""")
def geojson_nested(spark, sf):
    """Collections in collections, five deep, with geometry collections three deep, flattened by rounds."""
    b, name = F.col("box"), lambda text: F.create_map(F.lit("name"), text)
    rings = polygons(spark, sf).select("box_id", geojson.feature("Polygon", F.transform("rings", geojson.ring_positions), name(F.col("kind"))).alias("f"))
    documents = rings.groupBy("box_id").agg(geojson.feature_collection(F.collect_list("f")).alias("doc")).join(boxes(spark, sf), "box_id")
    geometry = lambda kind, member: F.concat(F.lit(f'{{"type":"{kind}",'), member, F.lit("}"))
    inner = None
    for k in range(1, 4):
        ends = F.array(geojson.position(b["west"] + k / 4, b["south"]), geojson.position(b["east"], b["north"]))
        line = geometry("LineString", F.concat(F.lit('"coordinates":'), F.to_json(ends)))
        members = line if inner is None else F.concat(inner, F.lit(","), line)
        inner = geometry("GeometryCollection", F.concat(F.lit('"geometries":['), members, F.lit("]")))
    deep = F.concat(F.lit('{"type":"Feature","properties":{"name":"inside"},"geometry":'), inner, F.lit("}"))
    documents = documents.withColumn("doc", geojson.feature_collection(F.array("doc", deep)))
    for k in range(1, _DEEP + 1):
        corner = geojson.feature("Point", geojson.position(b["west"] + k / 8, b["south"]), name(F.lit("corner")))
        documents = documents.withColumn("doc", geojson.feature_collection(F.array("doc", corner)))
    read = geojson.read_features(documents.select("box_id", "doc"), "doc", keep=["box_id"])
    # the first number of any coordinates
    first = F.regexp_extract("coordinates", r"^[\[]+([^,\]]+)", 1).cast("double")
    return read.groupBy("box_id", "geometry_type", F.col("properties")["name"].alias("name")).agg(
        F.count("*").alias("features"), r6(F.sum(first)).alias("x")
    )


@query("SELECT event_id, event_type FROM events WHERE event_type = 'error'")
def geojson_rejects(spark, sf):
    """Texts that are cut before their end go to the reject table."""
    whole = geojson.feature("Point", geojson.position(F.col("lon"), F.col("lat")))
    cut = F.when(F.col("event_type") == "error", F.substring(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    made = points(spark, sf).select("event_id", "event_type", cut.alias("doc"))
    return geojson.bad_documents(made, "doc").select("event_id", "event_type")
