"""Lines and rings held as one row per vertex, of any length; the nearest line of every point.

A line is the rows of some key columns in a given order. Neighbours and running sums come from
:func:`ordered_columns`, so a line is spread over tasks and no row holds a whole one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placetime.functions import geo
from placetime.operators.ordered import ordered_columns
from placetime.session import checkpointed

FLAT = 1e-12  # share of the summed sizes below which the area of a ring is rounding noise
SLACK = 1e-9  # of the whole extent: rounding must not lose a segment
PROBES = 12  # along each side of a block: more bound its distances tighter and take longer
LEAF = 8  # points that are compared with what is left of the segments one by one
SENT = 10_000  # rows of an Arrow batch
HELD = 20_000  # segments to a block, on average, where the points alone would ask for fewer blocks
TOGETHER = 4096  # segments in a task: with fewer the blocks, which every task goes through, take most of the time


def segments(vertices: DataFrame, keys: list[str], order: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """One row per vertex with the one before it: ax, ay, bx, by. The first of a line has no ax, ay."""
    placed = vertices.select(*keys, *order, F.col(x).cast("double").alias("bx"), F.col(y).cast("double").alias("by"))
    return ordered_columns(placed, keys, order, previous={"ax": "bx", "ay": "by"})


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(Column.__and__, (left[k].eqNullSafe(right[k]) for k in keys))


def line_measures(vertices: DataFrame, keys: list[str], order: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Per line its length and the point at half of it; a line without length gives its first vertex."""
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    steps = checkpointed(segments(vertices, keys, order, x, y).withColumn("step", F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0))))
    place = F.struct(*order)
    first = F.min_by(F.struct("bx", "by"), place)
    whole = checkpointed(steps.groupBy(*keys).agg(F.sum("step").alias("length"), first.alias("first")))
    run = ordered_columns(steps, keys, order, running={"gone": "step"})
    right = whole.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("length").alias("_length"))
    half = F.col("_length") / 2
    same = reduce(Column.__and__, (run[k].eqNullSafe(F.col(f"_{k}")) for k in keys))
    back = (F.col("gone") - half) / F.nullif(F.col("step"), F.lit(0.0))
    at = F.struct((F.col("bx") - back * dx).alias("x"), (F.col("by") - back * dy).alias("y"))
    middle = (
        run.join(right, same).where((F.col("gone") > half) & (half > 0) & (F.col("step") > 0))
        .groupBy(*keys).agg(F.min_by(at, place).alias("middle"))
    )
    return whole.join(middle, _same(whole, middle, keys), "left").select(
        *(whole[k] for k in keys), "length",
        F.coalesce(F.col("middle.x"), F.col("first.bx")).alias("x"), F.coalesce(F.col("middle.y"), F.col("first.by")).alias("y"),
    )


def ring_centroids(vertices: DataFrame, keys: list[str], order: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Per ring its area-weighted centroid, from sums over its sides; a ring without area gives its first vertex."""
    place, at = F.struct(*order), F.struct("bx", "by")
    cross = F.col("ay") * F.col("bx") - F.col("by") * F.col("ax")
    sums = segments(vertices, keys, order, x, y).groupBy(*keys).agg(
        F.coalesce(F.sum((F.col("ax") + F.col("bx")) * cross), F.lit(0.0)).alias("sx"),
        F.coalesce(F.sum((F.col("ay") + F.col("by")) * cross), F.lit(0.0)).alias("sy"),
        F.coalesce(F.sum(cross), F.lit(0.0)).alias("area"), F.coalesce(F.sum(F.abs(cross)), F.lit(0.0)).alias("size"),
        F.min_by(at, place).alias("first"), F.max_by(at, place).alias("last"),
    )
    # the side from the last vertex to the first
    ax, ay, bx, by = (F.col(c) for c in ("last.bx", "last.by", "first.bx", "first.by"))
    closing = ay * bx - by * ax
    area, size = F.col("area") + closing, F.col("size") + F.abs(closing)
    flat = F.abs(area) <= size * FLAT
    weight = F.nullif(3 * area, F.lit(0.0))
    return sums.select(
        *keys, area.alias("area"),
        F.when(flat, bx).otherwise((F.col("sx") + (ax + bx) * closing) / weight).alias("x"),
        F.when(flat, by).otherwise((F.col("sy") + (ay + by) * closing) / weight).alias("y"),
    )


def nearest_to(lines: DataFrame, keys: list[str], px: float, py: float) -> DataFrame:
    """Per line, from its ``segments``, the point nearest to one given point, and its distance."""
    near = geo.nearest_on_segment(F.lit(px), F.lit(py), "ax", "ay", "bx", "by")
    found = lines.where(F.col("ax").isNotNull()).withColumn("_near", near)
    best = F.min(F.struct(F.col("_near.distance").alias("distance"), F.col("_near.x").alias("x"), F.col("_near.y").alias("y")))
    return found.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")


# --- the nearest line of every point --------------------------------------------------

def _off2(sides: np.ndarray, x, y) -> np.ndarray:
    """Squared distances, but for rounding, of segments (ax, ay, dx, dy, 1 / length2, ...) from x, y."""
    qx, qy = x - sides[0], y - sides[1]
    along = (qx * sides[2] + qy * sides[3]) * sides[4]
    np.minimum(np.maximum(along, 0.0, out=along), 1.0, out=along)
    qx -= along * sides[2]
    qy -= along * sides[3]
    return qx * qx + qy * qy


def _sides(ax, ay, bx, by) -> np.ndarray:
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    some = length2 > 1e-300
    return np.stack([ax, ay, dx, dy, np.where(some, 1.0 / np.where(some, length2, 1.0), 0.0), np.where(length2 > 0, length2, 1.0)])


def _least(sides: np.ndarray, rank: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each point its nearest segment: number, distance, x and y there. The checks' order of operations decides what is equal."""
    ax, ay, dx, dy, _, length2 = sides
    qx, qy = x[:, None] - ax, y[:, None] - ay
    along = (qx * dx + qy * dy) / length2
    np.minimum(np.maximum(along, 0.0, out=along), 1.0, out=along)
    way_x, way_y = dx * along, dy * along
    at_x, at_y = ax + way_x, ay + way_y
    off = np.sqrt((qx - way_x) * (qx - way_x) + (qy - way_y) * (qy - way_y))
    each, best = np.arange(len(x)), off.argmin(axis=1)
    distance = off[each, best]
    same = off == distance[:, None]
    # of equal distances the least line, then the least point on it
    tied = np.flatnonzero(same.sum(axis=1) > 1)
    if len(tied):
        left = same[tied]
        for value in (np.broadcast_to(rank, left.shape), at_x[tied], at_y[tied]):
            value = np.where(left, value, np.inf)
            left &= value == value.min(axis=1)[:, None]
        best[tied] = left.argmax(axis=1)
    return best, distance, at_x[each, best], at_y[each, best]


def _quarters(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """The numbers of some points, by their place in four parts of about equal size."""
    half, parts = np.argpartition(x, len(x) // 2), []
    for part in (half[: len(x) // 2], half[len(x) // 2 :]):
        order = part[np.argpartition(y[part], len(part) // 2)]
        parts += [order[: len(part) // 2], order[len(part) // 2 :]]
    return [part for part in parts if len(part)]


def _nearest(sides: np.ndarray, rank: np.ndarray, x: np.ndarray, y: np.ndarray, slack: float) -> tuple[np.ndarray, ...]:
    """The nearest segment of every point, as by :func:`_least` with all of them.

    Points are parted in four again and again. No segment is nearest to a point of a part if it is farther from the
    part's middle than the nearest there by more than the width of the part, so each part keeps fewer segments.
    """
    best, found = np.empty(len(x), np.int64), np.empty((3, len(x)))
    todo = [(np.arange(len(x)), np.arange(sides.shape[1]), sides)]
    while todo:
        here, which, own = todo.pop()
        hx, hy = x[here], y[here]
        x0, x1, y0, y1 = hx.min(), hx.max(), hy.min(), hy.max()
        wide = ((x1 - x0) ** 2 + (y1 - y0) ** 2) ** 0.5
        if len(which) > LEAF:
            off = _off2(own, x0 + (x1 - x0) / 2, y0 + (y1 - y0) / 2)
            kept = np.flatnonzero(off <= (off.min() ** 0.5 + wide + slack) ** 2)
            which, own = which[kept], own[:, kept]
        if len(here) <= LEAF or wide == 0 or len(here) * len(which) <= LEAF * 512:
            one = slice(0, 1) if wide == 0 else slice(None)
            at, *rest = _least(own, rank[which], hx[one], hy[one])
            best[here] = which[at]
            for to, values in zip(found, rest, strict=True):
                to[here] = values
            continue
        todo += [(here[quarter], which, own) for quarter in _quarters(hx, hy)]
    return best, *found


def _within(sides: np.ndarray, x: np.ndarray, y: np.ndarray, reach: np.ndarray, slack: float) -> np.ndarray:
    """The segments that come within the reach of any of the places x, y, each with its own."""
    found = np.zeros(sides.shape[1], bool)
    todo = [(np.arange(len(x)), np.arange(sides.shape[1]))]
    while todo:
        here, which = todo.pop()
        which = which[~found[which]]
        if not len(which):
            continue
        hx, hy = x[here], y[here]
        mx, my = hx.min() + (hx.max() - hx.min()) / 2, hy.min() + (hy.max() - hy.min()) / 2
        most = (np.hypot(hx - mx, hy - my) + reach[here]).max() + slack
        which = which[_off2(sides[:, which], mx, my) <= most * most]
        if len(here) == 1:
            found[which] = True
        else:
            todo += [(here[quarter], which) for quarter in _quarters(hx, hy)]
    return np.flatnonzero(found)


def _placed(cuts: np.ndarray, rows: list[np.ndarray], tall: int, shares: np.ndarray) -> Callable:
    """Adds the number of a point's block (_cx) and its share of that (_cy). ``rows`` has the cuts across each strip."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_x", "_y"))
            strip = np.searchsorted(cuts, x, "right")
            block = strip * tall
            for at in np.unique(strip) if rows else ():
                here = strip == at
                block[here] += np.searchsorted(rows[at], y[here], "right")
            kept = batch.drop_columns(["_row"]) if "_row" in batch.schema.names else batch
            share = batch.column("_row").to_numpy(zero_copy_only=False) % shares[block] if len(shares) else np.zeros(len(block), int)
            yield kept.append_column("_cx", pa.array(block.astype(np.int32))).append_column("_cy", pa.array(share.astype(np.int32)))
    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches: the blocks are gone through for each of them."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= 16 * TOGETHER:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def _ends(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in ("ax", "ay", "bx", "by")]


def _probes(x0: float, x1: float, y0: float, y1: float) -> tuple[np.ndarray, np.ndarray]:
    """The middles of equal parts of a block, x and y, from column to column."""
    middles = (np.arange(PROBES) + 0.5) / PROBES
    return np.repeat(x0 + (x1 - x0) * middles, PROBES), np.tile(y0 + (y1 - y0) * middles, PROBES)


def _probed(blocks: np.ndarray, slack: float) -> Callable:
    """How far the nearest segment of a task is from each probe of every block: _cx, _cy (number of the probe), off."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.full((len(blocks), PROBES * PROBES), np.inf)
        for batch in _gathered(batches):
            sides = _sides(*_ends(batch))
            unranked = np.zeros(sides.shape[1])
            for at, (_, *corners) in enumerate(blocks):
                least[at] = np.minimum(least[at], _nearest(sides, unranked, *_probes(*corners), slack)[1])
        number = np.repeat(blocks[:, 0].astype(np.int32), PROBES * PROBES)
        probe = np.tile(np.arange(PROBES * PROBES, dtype=np.int32), len(blocks))
        for at in range(0, len(number), SENT):
            part = slice(at, at + SENT)
            yield pa.RecordBatch.from_arrays([pa.array(v[part]) for v in (number, probe, least.ravel())], ["_cx", "_cy", "off"])
    return run


def _spread(blocks: np.ndarray, reach: np.ndarray, shares: np.ndarray, slack: float) -> Callable:
    """Repeats each segment for the blocks (_cx) of which it comes within the reach of a probe, and every share (_cy) of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            sides, held, size = _sides(*_ends(batch)), [], 0

            def sent(held: list) -> pa.RecordBatch:
                rows, number, share = (np.concatenate(v) for v in zip(*held, strict=True))
                return batch.take(pa.array(rows)).append_column("_cx", pa.array(number)).append_column("_cy", pa.array(share))  # noqa: B023

            for (number, *corners), own in zip(blocks, reach, strict=True):
                rows = _within(sides, *_probes(*corners), own, slack)
                for share in range(shares[int(number)]):
                    held.append((rows, np.full(len(rows), int(number), np.int32), np.full(len(rows), share, np.int32)))
                    size += len(rows)
                    if size >= SENT:
                        yield sent(held)
                        held, size = [], 0
            if held:
                yield sent(held)
    return run


def _solved(keys: list[str], line: list[str], slack: float) -> Callable:
    """From rows of a block's points and segments, these in the order of ``line``, one row per point."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dots, sides in zip(batch.column("dots"), batch.column("sides"), strict=True):
                *names, x, y = dots.values.flatten()
                *lines, ax, ay, bx, by = sides.values.flatten()
                x, y, ax, ay, bx, by = (v.to_numpy(zero_copy_only=False) for v in (x, y, ax, ay, bx, by))
                # equal lines have one rank
                new = np.zeros(len(ax), bool)
                for column in lines:
                    before, after = column[:-1], column[1:]
                    differs = pc.if_else(pc.and_(before.is_null(), after.is_null()), False, pc.fill_null(pc.not_equal(before, after), True))
                    new[1:] |= differs.to_numpy(zero_copy_only=False)
                best, distance, at_x, at_y = _nearest(_sides(ax, ay, bx, by), new.cumsum().astype(float), x, y, slack)
                for at in range(0, len(x), SENT):
                    part = slice(at, at + SENT)
                    number = pa.array(best[part])
                    yield pa.RecordBatch.from_arrays(
                        [*(v[part] for v in names), *(v.take(number) for v in lines), *(pa.array(v[part]) for v in (distance, at_x, at_y))],
                        [*keys, *line, "distance", "near_x", "near_y"],
                    )
    return run


def nearest_lines(points: DataFrame, parts: DataFrame, keys: list[str], line: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """For every point the nearest segment of any line: ``keys`` of the point, ``line`` of the segment, distance, near_x, near_y.

    ``parts`` has the columns of ``line`` and ax, ay, bx, by; ``keys`` name a point. Points are dealt
    by their place into blocks of about equal size, by cuts found from the data. The distances of some places in a block
    bound those of all its points, so that a segment is sent only to the blocks of which a point can be as near to it.
    The points are read several times and not kept.
    Within a block the search is by smaller and smaller parts. The blocks grow with the root of the number of points:
    a long segment is repeated once for every block on its way, not for every cell. Many segments make more blocks.
    Ties go to the least ``line``. Without segments there is no row.
    """
    sound = parts.where(F.col("ax").isNotNull() & F.col("ay").isNotNull() & F.col("bx").isNotNull() & F.col("by").isNotNull())
    sound = sound.select(*line, *(F.col(c).cast("double").alias(c) for c in ("ax", "ay", "bx", "by")))
    left = points.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    # few rows with much work each: dealt over tasks
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sound = checkpointed(sound.repartition(tasks))
    known = sound.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.least("ax", "bx")).alias("west"), F.max(F.greatest("ax", "bx")).alias("east"),
        F.min(F.least("ay", "by")).alias("south"), F.max(F.greatest("ay", "by")).alias("north"),
    ).first()
    ends = left.agg(F.min("_x"), F.max("_x"), F.min("_y"), F.max("_y"), F.count("*").alias("n")).first()
    fields = [left.schema[k] for k in keys] + [sound.schema[c] for c in line]
    result = T.StructType([*fields, *(T.StructField(c, T.DoubleType()) for c in ("distance", "near_x", "near_y"))])
    if not known["n"] or not ends["n"]:
        return left.sparkSession.createDataFrame([], result)
    sound = sound.coalesce(min(tasks, 1 + known["n"] // TOGETHER))
    slack = SLACK * (max(known["east"], ends[1]) - min(known["west"], ends[0]) + max(known["north"], ends[3]) - min(known["south"], ends[2]))

    # strips of equal numbers of points, each cut across into blocks of equal numbers
    count = max(1, round(ends["n"] ** 0.5 / 16), min(ends["n"], known["n"] // HELD))
    wide, tall = ends[1] - ends[0], ends[3] - ends[2]
    strips = max(1, min(count, round((count * wide / tall) ** 0.5) if tall else count))
    tall = -(-count // strips)
    place = T.StructType([T.StructField("_x", T.DoubleType()), T.StructField("_y", T.DoubleType()), T.StructField("_cx", T.IntegerType()), T.StructField("_cy", T.IntegerType())])
    shift = lambda n: F.array(*(F.lit(i / n) for i in range(1, n)))
    cuts = np.array(left.agg(F.percentile_approx("_x", shift(strips), F.lit(10_000))).first()[0] if strips > 1 else [])
    rows = [np.array([])] * strips
    if tall > 1:
        across = left.select("_x", "_y").mapInArrow(_placed(cuts, [], 1, np.array([])), place)
        for strip, found in across.groupBy("_cx").agg(F.percentile_approx("_y", shift(tall), F.lit(10_000))).collect():
            rows[strip] = np.array(found)
    within = left.select("_x", "_y").mapInArrow(_placed(cuts, rows, tall, np.array([])), place)
    boxes = checkpointed(within.groupBy("_cx").agg(
        F.count(F.lit(1)).alias("n"), F.min("_x").alias("west"), F.max("_x").alias("east"), F.min("_y").alias("south"), F.max("_y").alias("north"),
    ))
    corners = ["west", "east", "south", "north"]
    blocks = np.array([tuple(r) for r in boxes.select("_cx", *corners).collect()], float)
    bounds = sound.select("ax", "ay", "bx", "by").mapInArrow(_probed(blocks, slack), "_cx int, _cy int, off double")
    bounds = bounds.groupBy("_cx", "_cy").agg(F.min("off").alias("off"))
    bounds = bounds.groupBy("_cx").agg(F.array_sort(F.collect_list(F.struct("_cy", "off"))).alias("probes"))
    shares, reach = np.ones(strips * tall, int), np.empty((len(blocks), PROBES * PROBES))
    row_of = {int(b[0]): at for at, b in enumerate(blocks)}
    for r in checkpointed(boxes.join(bounds.hint("merge"), "_cx")).collect():
        # many points at one place come in one block
        shares[r["_cx"]] = -(-r["n"] * count // (2 * ends["n"]))
        # a point is as far from the probe beside it as half a part of the block is wide, and its nearest segment at most
        # so much farther from it than from the probe: what is nearest to it is in the reach of the probe
        half = math.hypot(r["east"] - r["west"], r["north"] - r["south"]) / (2 * PROBES)
        reach[row_of[r["_cx"]]] = [p["off"] + 2 * half for p in r["probes"]]

    tasks = max(tasks, int(shares.sum()) // 8)
    located = T.StructType([*(left.schema[k] for k in keys), *place.fields])
    dots = left.withColumn("_row", F.xxhash64(*keys, "_x", "_y")).mapInArrow(_placed(cuts, rows, tall, shares), located)
    dots = dots.repartition(tasks, "_cx", "_cy").groupBy("_cx", "_cy").agg(F.collect_set(F.struct(*keys, "_x", "_y")).alias("dots"))
    met = sound.mapInArrow(_spread(blocks, reach, shares, slack), T.StructType([*sound.schema.fields, *place.fields[2:]]))
    sides = F.array_sort(F.collect_list(F.struct(*line, "ax", "ay", "bx", "by"))).alias("sides")
    met = met.repartition(tasks, "_cx", "_cy").groupBy("_cx", "_cy").agg(sides)
    return dots.join(met.hint("merge"), ["_cx", "_cy"]).select("dots", "sides").mapInArrow(_solved(keys, line, slack), result)
