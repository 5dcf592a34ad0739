"""Lines and rings held as ``array<struct<x, y>>``: clipping, centroid, midpoint, containment.

One feature is one row, so each expression works within a row and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetime.functions import values

VERTEX = "struct<x:double,y:double>"


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def vertex(x, y) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def sides(ring: Column | str) -> Column:
    """Array of (a, b) vertex pairs: each vertex with the one before it, the first with the last."""
    ring = _c(ring)
    before = F.concat(F.slice(ring, F.lit(-1), F.lit(1)), F.slice(ring, F.lit(1), F.size(ring) - 1))
    return F.when(F.size(ring) > 0, F.arrays_zip(before.alias("a"), ring.alias("b"))).otherwise(
        F.array().cast(f"array<struct<a:{VERTEX},b:{VERTEX}>>")
    )


def all_sides(rings: Column | str) -> Column:
    """Sides of all rings of a polygon in one array."""
    return F.flatten(F.transform(_c(rings), sides))


def odd_crossings(sides_: Column | str, x, y) -> Column:
    """Even-odd test of a point against a polygon's sides."""
    x, y = _c(x), _c(y)

    def crosses(side: Column) -> Column:
        a, b = side["a"], side["b"]
        meets = (a["y"] > y) != (b["y"] > y)
        return meets & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])

    return F.size(F.filter(_c(sides_), crosses)) % 2 == 1


def contains_point(rings: Column | str, x, y) -> Column:
    """Whether a polygon holds a point, by the even-odd rule over all rings."""
    return odd_crossings(all_sides(rings), x, y)


def ring_centroid(ring: Column | str) -> Column:
    """Area-weighted centroid; a ring without area gives its first vertex."""
    ring = _c(ring)

    def add(acc: Column, side: Column) -> Column:
        a, b = side["a"], side["b"]
        cross = a["y"] * b["x"] - b["y"] * a["x"]
        return F.struct(
            (acc["sx"] + (a["x"] + b["x"]) * cross).alias("sx"),
            (acc["sy"] + (a["y"] + b["y"]) * cross).alias("sy"),
            (acc["area"] + cross * 3).alias("area"),
        )

    zero = F.struct(F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"), F.lit(0.0).alias("area"))
    first = F.get(ring, F.lit(0))
    return F.aggregate(
        sides(ring), zero, add,
        lambda acc: F.when(acc["area"] == 0, vertex(first["x"], first["y"])).otherwise(
            vertex(acc["sx"] / F.nullif(acc["area"], F.lit(0.0)), acc["sy"] / F.nullif(acc["area"], F.lit(0.0)))
        ),
    )


def _length(a: Column, b: Column) -> Column:
    return F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"]))


def line_steps(line: Column | str) -> Column:
    """Array of (a, b) pairs of consecutive vertices of an open line."""
    line = _c(line)
    count = F.greatest(F.size(line) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(line, F.lit(1), count).alias("a"), F.slice(line, F.lit(2), count).alias("b")
    )


def line_length(line: Column | str) -> Column:
    return F.aggregate(line_steps(line), F.lit(0.0), lambda acc, s: acc + _length(s["a"], s["b"]))


def line_midpoint(line: Column | str) -> Column:
    """Point at half the length; a line without length gives its first vertex."""
    line = _c(line)
    first = F.get(line, F.lit(0))

    def at_half(half: Column) -> Column:
        def walk(acc: Column, step: Column) -> Column:
            a, b = step["a"], step["b"]
            length = _length(a, b)
            reached = acc["gone"] + length
            back = (reached - half) / F.nullif(length, F.lit(0.0))
            here = vertex(b["x"] - back * (b["x"] - a["x"]), b["y"] - back * (b["y"] - a["y"]))
            found = acc["at"].isNull() & (half > 0) & (reached > half)
            return F.struct(
                reached.alias("gone"), F.when(found, here).otherwise(acc["at"]).alias("at")
            )

        start = F.struct(F.lit(0.0).alias("gone"), F.lit(None).cast(VERTEX).alias("at"))
        return F.aggregate(
            line_steps(line), start, walk,
            lambda acc: F.coalesce(acc["at"], vertex(first["x"], first["y"])),
        )

    return values.let(line_length(line) / 2, at_half)


def _clip_side(axis: str, limit: Column, sign: int):
    """What a ring side leaves behind when clipped at one line: cut point, end vertex, or none."""
    other = "y" if axis == "x" else "x"

    def keep(side: Column) -> Column:
        a, b = side["a"], side["b"]
        a_in = (a[axis] - limit) * sign >= 0
        b_in = (b[axis] - limit) * sign >= 0
        share = (limit - a[axis]) / F.nullif(b[axis] - a[axis], F.lit(0.0))
        across = a[other] + (b[other] - a[other]) * share
        cut = vertex(limit, across) if axis == "x" else vertex(across, limit)
        end = vertex(b["x"], b["y"])
        return (
            F.when(a_in & b_in, F.array(end))
            .when(b_in, F.array(cut, end))
            .when(a_in, F.array(cut))
            .otherwise(F.array().cast(f"array<{VERTEX}>"))
        )

    return keep


def clip_rings(df: DataFrame, ring: str, box: str, into: str) -> DataFrame:
    """Clip a ring column to a box column, one box side after the other.

    Each side is a column of its own, so that its result is computed once.
    """
    df = df.withColumn(into, F.col(ring))
    for axis, edge, sign in (("x", "west", 1), ("x", "east", -1), ("y", "south", 1), ("y", "north", -1)):
        pieces = F.transform(sides(into), _clip_side(axis, F.col(box)[edge], sign))
        df = df.withColumn(into, F.flatten(pieces))
    # a one-element explode keeps later filters from repeating the four steps
    return df.select(*(c for c in df.columns if c != into), F.explode(F.array(into)).alias(into))
