"""Projections, tile addresses, boxes and segments as column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spheres, ellipsoid and limits that results depend on.
EARTH_RADIUS = 6371000.0
MERCATOR_RADIUS = 6378137.0
MERCATOR_RADIUS_MINOR = 6356752.314245179
MAX_LATITUDE = 85.0511287798
EQUATOR_METRES = 40075017.0
FLAT_BOX_PAD = 0.006
SAME_POINT_MARGIN = 1e-9

_RATIO = MERCATOR_RADIUS_MINOR / MERCATOR_RADIUS
_ECCENTRICITY = math.sqrt(1 - _RATIO * _RATIO)

ColumnLike = Column | str


def _c(value: ColumnLike | float | int) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    return F.lit(float(value))


# --- points -----------------------------------------------------------------

def point(lon: ColumnLike, lat: ColumnLike) -> Column:
    """Point struct; a missing coordinate fails the job."""
    lon, lat = _c(lon).cast("double"), _c(lat).cast("double")
    whole = lon.isNotNull() & lat.isNotNull()
    checked = F.when(whole, lon).otherwise(
        F.raise_error(F.lit("point with a missing coordinate")).cast("double")
    )
    return F.struct(checked.alias("lon"), lat.alias("lat"))


def is_coordinate(value: ColumnLike) -> Column:
    """True when the value reads as a finite number."""
    number = _c(value).try_cast("double")
    return F.coalesce(~F.isnan(number) & (F.abs(number) < float("inf")), F.lit(False))


def great_circle(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS) -> Column:
    """Haversine distance in metres."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # rounding can push the chord of two opposite points just past 1
    return F.atan2(F.sqrt(chord), F.sqrt(F.greatest(F.lit(0.0), 1 - chord))) * (2 * radius)


def same_point(lat1, lon1, lat2, lon2, margin: float = SAME_POINT_MARGIN) -> Column:
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    return F.greatest(F.abs(lat1 - lat2), F.abs(lon1 - lon2)) <= margin


def wrap_longitude(lon, low: float = -180.0, high: float = 180.0, keep_high: bool = True) -> Column:
    """Fold a value into [low, high); the upper end itself stays when asked."""
    lon = _c(lon)
    folded = F.pmod(lon - low, F.lit(high - low)) + low
    return F.when(lon == high, lon).otherwise(folded) if keep_high else folded


# --- projections ------------------------------------------------------------

def mercator_xy(lat, lon) -> Column:
    """Spherical Web Mercator in metres."""
    lat, lon = _c(lat), _c(lon)
    clamped = F.greatest(F.lit(-MAX_LATITUDE), F.least(F.lit(MAX_LATITUDE), lat))
    s = F.sin(F.radians(clamped))
    return F.struct(
        (F.radians(lon) * MERCATOR_RADIUS).alias("x"),
        (F.log((1 + s) / (1 - s)) * (MERCATOR_RADIUS / 2)).alias("y"),
    )


def mercator_latlon(x, y) -> Column:
    x, y = _c(x), _c(y)
    return F.struct(
        F.degrees(2 * F.atan(F.exp(y / MERCATOR_RADIUS)) - math.pi / 2).alias("lat"),
        F.degrees(x / MERCATOR_RADIUS).alias("lon"),
    )


def _flattening(phi: Column) -> Column:
    s = F.sin(phi) * _ECCENTRICITY
    return F.pow((1 - s) / (1 + s), F.lit(_ECCENTRICITY / 2))


def ellipsoid_xy(lat, lon) -> Column:
    """Ellipsoidal Mercator in metres."""
    phi, lon = F.radians(_c(lat)), _c(lon)
    ratio = F.tan(math.pi / 4 - phi / 2) / _flattening(phi)
    return F.struct(
        (F.radians(lon) * MERCATOR_RADIUS).alias("x"),
        (F.log(F.greatest(ratio, F.lit(1e-10))) * -MERCATOR_RADIUS).alias("y"),
    )


def ellipsoid_latlon(x, y, rounds: int = 15, tolerance: float = 1e-7) -> Column:
    """Inverse of :func:`ellipsoid_xy`: a fixed-point search that stops when it settles."""
    x, y = _c(x), _c(y)
    shrink = F.exp(-y / MERCATOR_RADIUS)

    def state(phi: Column, step: Column) -> Column:
        return F.struct(phi.alias("phi"), step.alias("step"))

    def improve(acc: Column, _round: Column) -> Column:
        better = math.pi / 2 - 2 * F.atan(shrink * _flattening(acc["phi"]))
        return F.when(
            F.abs(acc["step"]) > tolerance, state(better, better - acc["phi"])
        ).otherwise(acc)

    start = state(math.pi / 2 - 2 * F.atan(shrink), F.lit(0.1))
    settled = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, improve)
    return F.struct(
        F.degrees(settled["phi"]).alias("lat"), F.degrees(x / MERCATOR_RADIUS).alias("lon")
    )


def pixel_position(lat, lon, zoom, crs: str = "EPSG:3857") -> Column:
    """Pixel (x, y) of a coordinate at a zoom level in one of four reference systems."""
    lat, lon, zoom = _c(lat), _c(lon), _c(zoom)
    world = F.pow(F.lit(2.0), zoom) * 256
    if crs == "Simple":
        unit = F.pow(F.lit(2.0), zoom)
        return F.struct((lon * unit).alias("x"), (-lat * unit).alias("y"))
    if crs == "EPSG:4326":
        return F.struct(
            ((lon / 180 + 1) * world).alias("x"), ((lat / -180 + 0.5) * world).alias("y")
        )
    if crs not in ("EPSG:3857", "EPSG:3395"):
        raise ValueError(f"unknown reference system {crs!r}")
    metres = mercator_xy(lat, lon) if crs == "EPSG:3857" else ellipsoid_xy(lat, lon)
    unit = 0.5 / (math.pi * MERCATOR_RADIUS)
    return F.struct(
        ((metres["x"] * unit + 0.5) * world).alias("x"),
        ((metres["y"] * -unit + 0.5) * world).alias("y"),
    )


# --- tiles ------------------------------------------------------------------

def tile_xy(lat, lon, zoom) -> Column:
    """Fractional slippy-map tile position."""
    lat, lon, zoom = _c(lat), _c(lon), _c(zoom)
    n = F.pow(F.lit(2.0), zoom)
    phi = F.radians(lat)
    return F.struct(
        ((lon + 180) / 360 * n).alias("x"),
        ((1 - F.log(F.tan(phi) + 1 / F.cos(phi)) / math.pi) / 2 * n).alias("y"),
    )


def tile_index(lat, lon, zoom) -> Column:
    at = tile_xy(lat, lon, zoom)
    return F.struct(F.floor(at["x"]).alias("x"), F.floor(at["y"]).alias("y"))


def tile_key(x, y, zoom) -> Column:
    return F.concat_ws(":", _c(x).cast("long"), _c(y).cast("long"), _c(zoom).cast("int"))


def tiles_over(low, high, size: float = 256.0) -> Column:
    """Indices of the tiles of ``size`` pixels that cover [low, high] on one axis."""
    first = F.floor(_c(low) / size)
    last = F.ceil(_c(high) / size) - 1
    return F.when(last >= first, F.sequence(first, last)).otherwise(
        F.array().cast("array<bigint>")
    )


# --- boxes ------------------------------------------------------------------

def box(south, west, north, east) -> Column:
    names = ("south", "west", "north", "east")
    return F.struct(*(_c(v).alias(n) for v, n in zip((south, west, north, east), names)))


def box_contains_point(b: ColumnLike, lat, lon) -> Column:
    b, lat, lon = _c(b), _c(lat), _c(lon)
    return (lat >= b["south"]) & (lat <= b["north"]) & (lon >= b["west"]) & (lon <= b["east"])


def box_contains(b: ColumnLike, inner: ColumnLike) -> Column:
    b, inner = _c(b), _c(inner)
    return box_contains_point(b, inner["south"], inner["west"]) & box_contains_point(
        b, inner["north"], inner["east"]
    )


def box_intersects(a: ColumnLike, b: ColumnLike) -> Column:
    """Closed test: a shared edge counts."""
    a, b = _c(a), _c(b)
    return (
        (b["north"] >= a["south"]) & (b["south"] <= a["north"])
        & (b["east"] >= a["west"]) & (b["west"] <= a["east"])
    )


def box_overlaps(a: ColumnLike, b: ColumnLike) -> Column:
    """Open test: the common part must have an area."""
    a, b = _c(a), _c(b)
    return (
        (b["north"] > a["south"]) & (b["south"] < a["north"])
        & (b["east"] > a["west"]) & (b["west"] < a["east"])
    )


def box_pad(b: ColumnLike, ratio: float) -> Column:
    b = _c(b)
    tall = F.abs(b["south"] - b["north"]) * ratio
    wide = F.abs(b["west"] - b["east"]) * ratio
    return box(b["south"] - tall, b["west"] - wide, b["north"] + tall, b["east"] + wide)


def box_centre(b: ColumnLike) -> Column:
    b = _c(b)
    return F.struct(
        ((b["south"] + b["north"]) / 2).alias("lat"), ((b["west"] + b["east"]) / 2).alias("lon")
    )


def box_text(b: ColumnLike) -> Column:
    b = _c(b)
    return F.concat_ws(",", b["west"], b["south"], b["east"], b["north"])


def box_around(lat, lon, metres) -> Column:
    """Box whose sides are ``metres`` long, centred on a point."""
    lat, lon, metres = _c(lat), _c(lon), _c(metres)
    up = metres * (180 / EQUATOR_METRES)
    across = up / F.cos(F.radians(lat))
    return box(lat - up, lon - across, lat + up, lon + across)


def view_zoom(b: ColumnLike, width: float, height: float, low: float = 0.0, high: float = 18.0) -> Column:
    """Largest whole zoom at which the box fits a window of width x height pixels."""
    b = _c(b)
    flat = b["south"] == b["north"]
    thin = b["west"] == b["east"]
    south = F.when(flat, b["south"] - FLAT_BOX_PAD).otherwise(b["south"])
    north = F.when(flat, b["north"] + FLAT_BOX_PAD).otherwise(b["north"])
    west = F.when(thin, b["west"] - FLAT_BOX_PAD).otherwise(b["west"])
    east = F.when(thin, b["east"] + FLAT_BOX_PAD).otherwise(b["east"])
    top_left = pixel_position(north, west, 0)
    bottom_right = pixel_position(south, east, 0)
    scale = F.least(
        width / F.abs(bottom_right["x"] - top_left["x"]),
        height / F.abs(bottom_right["y"] - top_left["y"]),
    )
    hundredths = F.floor(F.log2(scale) * 100 + 0.5) / 100
    return F.greatest(F.lit(low), F.least(F.lit(high), F.floor(hundredths).cast("double")))


# --- segments ---------------------------------------------------------------

def clip_segment(x1, y1, x2, y2, b: ColumnLike) -> Column:
    """Part of a segment inside a box, or null: the parameter range kept by four edges."""
    x1, y1, x2, y2 = map(_c, (x1, y1, x2, y2))
    b = _c(b)
    dx, dy = x2 - x1, y2 - y1
    edges = (
        (-dx, x1 - b["west"]), (dx, b["east"] - x1), (-dy, y1 - b["south"]), (dy, b["north"] - y1),
    )
    zero = F.lit(0.0)
    enter = F.greatest(zero, *(F.when(p < 0, q / p).otherwise(0.0) for p, q in edges))
    leave = F.least(F.lit(1.0), *(F.when(p > 0, q / p).otherwise(1.0) for p, q in edges))
    parallel_outside = F.lit(False)
    for p, q in edges:
        parallel_outside = parallel_outside | ((p == 0) & (q < 0))
    piece = F.struct(
        (x1 + dx * enter).alias("x1"), (y1 + dy * enter).alias("y1"),
        (x1 + dx * leave).alias("x2"), (y1 + dy * leave).alias("y2"),
    )
    return F.when(~parallel_outside & (enter <= leave), piece)


def nearest_on_segment(px, py, x1, y1, x2, y2) -> Column:
    """Closest point of a segment and the distance to it."""
    px, py, x1, y1, x2, y2 = map(_c, (px, py, x1, y1, x2, y2))
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    along = F.when(length2 > 0, ((px - x1) * dx + (py - y1) * dy) / length2).otherwise(0.0)
    along = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    x, y = x1 + dx * along, y1 + dy * along
    distance = F.sqrt((px - x) * (px - x) + (py - y) * (py - y))
    return F.struct(x.alias("x"), y.alias("y"), distance.alias("distance"))
