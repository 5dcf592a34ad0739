"""Order-dependent event work: leading-edge throttle and fixed-size batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetime.functions import values
from placetime.operators.ordered import range_bounds, range_number
from placetime.session import checkpointed

BATCH_SIZE = 20  # fixed value: items per batch
THROTTLE_MS = 50  # fixed value: default wait of the throttle
NEVER = -(2**62)


def kept_positions(at: np.ndarray, wait: int, open_from: int) -> np.ndarray:
    """Positions of the sorted times that pass when the gate opens at ``open_from``."""
    kept, i = [], int(np.searchsorted(at, open_from))
    while i < len(at):
        kept.append(i)
        i = int(np.searchsorted(at, at[i] + wait))
    return np.array(kept, dtype=np.int64)


def whole_groups(frames: Iterator[pd.DataFrame], keys: list[str], rows: int = 100_000) -> Iterator[pd.DataFrame]:
    """Regroup a key-sorted stream of frames in blocks that cut no group in two.

    A block has about ``rows`` rows, or one group if that is larger.
    """
    held: list[pd.DataFrame] = []
    count, enough = 0, rows
    for frame in frames:
        held.append(frame)
        count += len(frame)
        if count < enough or not count:
            continue
        block = pd.concat(held, ignore_index=True)
        last = block.iloc[-1]
        unfinished = np.logical_and.reduce(
            [(block[k] == last[k]) | (block[k].isna() & pd.isna(last[k])) for k in keys]
        )
        if unfinished.all():
            held, enough = [block], 2 * count
            continue
        yield block[~unfinished]
        held, enough = [block[unfinished]], rows
        count = len(held[0])
    if count:
        yield pd.concat(held, ignore_index=True)


def _segments(frame: pd.DataFrame, by: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """First position of each run of equal values, and the run of every row."""
    fresh = np.zeros(len(frame), bool)
    fresh[:1] = True
    for c in by:
        codes = pd.factorize(frame[c], use_na_sentinel=False)[0]
        fresh[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(fresh), np.cumsum(fresh) - 1


def _next_open(at: np.ndarray, first: np.ndarray, wait: int) -> np.ndarray:
    """For each event the next of its segment that passes if it does, or the next segment's first.

    All segments lie on one line: steps of more than a wait are as good as one wait.
    """
    step = np.diff(at, prepend=0)
    step[first] = wait
    line = np.cumsum(np.minimum(step, wait))
    return np.searchsorted(line, line + wait)


def throttle(df: DataFrame, key: str, ts: str, tie: str, wait_ms: int = THROTTLE_MS, ranges: int | None = None, fan_in: int = 16) -> DataFrame:
    """Let one event per key through, drop the rest for ``wait_ms``, repeat.

    Exact for keys of any size. Only the first event of a key at one instant can pass,
    so the rest go in a pre-aggregation. Events are cut in ranges of (key, time) of about equal size, so
    only the first and last key of a range can go on in another one. For these each range reports
    a map: from the moment the gate opens to the last event that the range lets through. The maps of
    ``fan_in`` ranges that follow each other are composed to one, in rounds; going back down, the composed
    maps give the moment the gate opens for each range, and all ranges then run in parallel.
    """
    wait = max(1, wait_ms * 1000)
    kind = df.schema[ts].dataType.simpleString()
    key_type, tie_type = (df.schema[c].dataType.simpleString() for c in (key, tie))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * parts
    timed = df.withColumn("_at", values.micros(ts, kind))
    bounds = range_bounds(timed.select(key, "_at"), [key, "_at"], ranges).scalar()
    instants = timed.groupBy(key, "_at").agg(F.min(tie).alias(tie)).withColumn("_bounds", bounds)
    cut = checkpointed(
        instants.select(key, range_number(F.col("_bounds"), F.struct(key, "_at"), ranges).alias("_range"), "_at", tie)
        .repartitionById(parts, F.col("_range")).sortWithinPartitions("_range", key, "_at")
    )

    def report(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, ["_range"]):
            at = frame["_at"].to_numpy()
            first, segment = _segments(frame, ["_range", key])
            stop = np.append(first[1:], len(frame))
            after = _next_open(at, first, wait)
            here = np.arange(len(frame))
            last = np.where(after < stop[segment], after, here)
            while not np.array_equal(last[last], last):
                last = last[last]
            outer, _ = _segments(frame, ["_range"])
            edges = np.union1d(segment[outer], segment[np.append(outer[1:], len(frame)) - 1])
            for k in edges:
                own = slice(first[k], stop[k])
                openers, ends = _reachable(at[own], at[last[own]], wait)
                yield pd.DataFrame({key: frame[key].iloc[[first[k]] * len(openers)], "_node": frame["_range"].iloc[first[k]], "_opener": openers, "_end": ends})

    def composed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_node", "_opener"])
        first, _ = _segments(frame, ["_node"])
        openers, ends = frame["_opener"].to_numpy(), frame["_end"].to_numpy()
        stop = np.append(first[1:], len(frame))
        # from the last map back: what the later ones make of each end
        later_openers, later_ends = openers[first[-1]:], ends[first[-1]:]
        for a, b in zip(first[-2::-1], stop[-2::-1], strict=True):
            place = np.searchsorted(later_openers, ends[a:b] + wait)
            known = np.append(later_ends, 0)[place]
            later_ends = np.append(np.where(place < len(later_openers), known, ends[a:b]), later_ends)
            later_openers = np.append(openers[a:b], later_openers)
            later_openers, later_ends = _reachable(later_openers, later_ends, wait)
        return pd.DataFrame({key: frame[key].iloc[[0] * len(later_openers)], "_node": frame["_node"].iloc[0] // fan_in, "_opener": later_openers, "_end": later_ends})

    def followed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_node", "_opener"])
        first, _ = _segments(frame, ["_node"])
        openers, ends = frame["_opener"].to_numpy(), frame["_end"].to_numpy()
        gate, gates = int(frame["_gate"].iloc[0]), []
        for a, b in zip(first, np.append(first[1:], len(frame)), strict=True):
            gates.append(gate)
            place = a + int(np.searchsorted(openers[a:b], gate))
            if place < b:
                gate = int(ends[place]) + wait
        return pd.DataFrame({key: frame[key].to_numpy()[first], "_node": frame["_node"].to_numpy()[first], "_gate": gates})

    def passed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, ["_range"]):
            at = frame["_at"].to_numpy()
            first, segment = _segments(frame, ["_range", key])
            stop = np.append(first[1:], len(frame))
            after = _next_open(at, first, wait)
            now, gates = first.copy(), frame["_gate"].to_numpy()[first]
            for k in np.flatnonzero(gates > NEVER):
                now[k] += int(np.searchsorted(at[first[k]:stop[k]], gates[k]))
            now, kept = now[now < stop], []
            while len(now):
                kept.append(now)
                step = after[now]
                now = step[step < stop[segment[now]]]
            yield frame[[key, "_at", tie]].iloc[np.sort(np.concatenate(kept))] if kept else frame[[key, "_at", tie]].iloc[:0]

    map_type = f"{key} {key_type}, _node bigint, _opener bigint, _end bigint"
    maps = [cut.select(key, "_range", "_at").mapInPandas(report, map_type)]
    parent = F.floor(F.col("_node") / fan_in).alias("_parent")
    while fan_in ** len(maps) < ranges:
        maps.append(maps[-1].groupBy(key, parent).applyInPandas(composed, map_type))
    gates = None
    for level in reversed(maps):
        held = level.withColumn("_parent", parent)
        if gates is None:
            held = held.withColumn("_gate", F.lit(NEVER))
        else:
            above = gates.select(F.col(key).alias("_key"), F.col("_node").alias("_parent"), "_gate")
            held = held.join(above, F.col(key).eqNullSafe(F.col("_key")) & (held["_parent"] == above["_parent"])).select(held["*"], "_gate")
        gates = held.groupBy(key, "_parent").applyInPandas(followed, f"{key} {key_type}, _node bigint, _gate bigint")
    # at most two rows per range
    opened = F.broadcast(gates.select(F.col(key).alias("_key"), "_node", "_gate"))
    gated = cut.join(opened, cut[key].eqNullSafe(F.col("_key")) & (cut["_range"] == F.col("_node")), "left")
    kept = (
        gated.select(key, "_range", "_at", tie, F.coalesce("_gate", F.lit(NEVER)).alias("_gate"))
        .mapInPandas(passed, f"{key} {key_type}, _at bigint, {tie} {tie_type}")
    )
    return kept.select(key, values.from_micros("_at", kind).alias(ts), tie)


def _reachable(openers: np.ndarray, ends: np.ndarray, wait: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of a map that is asked for: the gate opens within a wait of the first event.

    Of openers that follow each other and have the same end the latest stays.
    """
    some = int(np.searchsorted(openers, openers[0] + wait)) + 1
    openers, ends = openers[:some], ends[:some]
    last = np.append(ends[1:] != ends[:-1], True)
    return openers[last], ends[last]


def batches(df: DataFrame, items: str, size: int = BATCH_SIZE) -> DataFrame:
    """One row per batch of at most ``size`` items; the other columns are copied."""
    rest = [c for c in df.columns if c != items]
    # the outer form keeps Spark from cutting the array once more to test its size
    cut = df.select(*rest, F.posexplode_outer(values.chunks(items, size)).alias("batch", items))
    return cut.where(F.col("batch").isNotNull())
