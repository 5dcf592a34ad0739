"""Ranks, running sums and neighbours over ordered groups of any size.

A plain window over ``partitionBy(key)`` sends a whole group to one task. Here the rows
are cut in ranges of (keys, order) of about equal size, as a sort by range would cut them;
windows run inside a range, and one summary row per range and group carries totals to the later ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placetime.session import checkpointed

SAMPLED = 32  # rows of the sample for each range


def range_bounds(df: DataFrame, columns: list[str], ranges: int) -> DataFrame:
    """One row: the sorted positions at which ``df`` is cut in about equal ranges, fewer than ``ranges``.

    A hash of the position deals rows to buckets, and each bucket's least hash stays: a sample
    of fixed size that does not depend on how rows are dealt to tasks.
    """
    position = F.struct(*(F.col(c) for c in columns))
    mark = F.xxhash64(*columns)
    sample = (
        df.select(position.alias("_at"), mark.alias("_mark"))
        .groupBy(F.pmod("_mark", F.lit(ranges * SAMPLED)).alias("_bucket")).agg(F.min_by("_at", F.col("_mark")).alias("_at"))
    )
    found = F.array_sort(F.collect_list("_at"))
    step = F.greatest(F.size("_all") / F.lit(ranges), F.lit(1.0))
    places = F.when(F.size("_all") > 1, F.sequence(F.lit(1), F.least(F.lit(ranges), F.size("_all")) - 1))
    picked = F.transform(places, lambda i: F.get("_all", F.floor(i * step).cast("int")))
    return sample.agg(found.alias("_all")).select(picked.alias("bounds"))


def range_number(bounds: Column, position: Column, ranges: int) -> Column:
    """How many of the sorted bounds lie at or below a position, by bisection."""
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(max(1, ranges.bit_length())))))
    ahead = lambda at, step: at + F.when(F.get(bounds, at + step - 1) <= position, step).otherwise(0)
    return F.aggregate(steps, F.lit(0), ahead)


def ordered_columns(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    rank: str | None = None,
    running: dict[str, str] | None = None,
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add order-dependent columns per group.

    ``order`` must be total within a group. ``rank`` names a 1-based row number; ``running``
    maps a new column to the column whose sum up to and including the row it holds; ``previous``
    and ``following`` map a new column to the column taken from the row before or after.
    ``ranges`` defaults to the number of shuffle partitions. ``df`` is read three times, and its rows
    are shuffled once.
    """
    running, previous, following = running or {}, previous or {}, following or {}
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    along = [*keys, *order]
    bounds = range_bounds(df, along, ranges).scalar()
    part = [*keys, "_range"]
    # the bounds are a column first: an expression with a lambda takes no subquery
    cut = df.withColumn("_bounds", bounds).withColumn("_range", range_number(F.col("_bounds"), F.struct(*along), ranges)).drop("_bounds")
    inside = W.partitionBy(*part).orderBy(*order)

    rows = cut.withColumns(
        {"_rn": F.row_number().over(inside)}
        | {f"_run_{n}": F.sum(c).over(inside.rowsBetween(W.unboundedPreceding, 0)) for n, c in running.items()}
        | {f"_prev_{n}": F.lag(c).over(inside) for n, c in previous.items()}
        | {f"_next_{n}": F.lead(c).over(inside) for n, c in following.items()}
    )

    position = F.struct(*order)
    summary = cut.groupBy(*part).agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.sum(c).alias(f"_sum_{n}") for n, c in running.items()),
        *(F.max_by(c, position).alias(f"_last_{n}") for n, c in previous.items()),
        *(F.min_by(c, position).alias(f"_first_{n}") for n, c in following.items()),
    )
    right = _carried(summary, keys, running, previous, following)
    same = reduce(Column.__and__, (rows[c].eqNullSafe(right[f"_r{c}"]) for c in part))
    joined = rows.join(right, same, "inner")
    added = {}
    if rank:
        added[rank] = F.col("_rn") + F.col("_rows_before")
    for n in running:
        own, before = F.col(f"_run_{n}"), F.col(f"_sum_before_{n}")
        added[n] = F.when(before.isNull(), own).otherwise(before + F.coalesce(own, F.lit(0)))
    for n in previous:
        added[n] = F.when(F.col("_rn") == 1, F.col(f"_last_before_{n}")).otherwise(F.col(f"_prev_{n}"))
    for n in following:
        is_last = F.col("_rn") == F.col("_rows")
        added[n] = F.when(is_last, F.col(f"_first_after_{n}")).otherwise(F.col(f"_next_{n}"))
    kept = [F.col(c) for c in df.columns if c not in added]
    return joined.select(*kept, *(column.alias(name) for name, column in added.items()))


def _carried(summary: DataFrame, keys: list[str], running: dict, previous: dict, following: dict) -> DataFrame:
    """What the ranges of a group before and after each range add to its rows.

    A group has at most one summary row per range, so its summaries fit in one array.
    """
    fields = [c for c in summary.columns if c not in keys]
    listed = F.array_sort(F.collect_list(F.struct(*fields)))
    gathered = summary.groupBy(*keys).agg(listed.alias("_list"))

    def before(i: Column, field: str) -> Column:
        values = F.transform(F.slice("_list", F.lit(1), i), lambda x: x[field])
        known = F.filter(values, lambda v: v.isNotNull())
        return F.when(F.size(known) > 0, F.aggregate(F.slice(known, 2, F.size(known)), F.get(known, F.lit(0)), lambda a, v: a + v))

    def line(x: Column, i: Column) -> Column:
        return F.struct(
            x["_range"].alias("_r_range"), x["_rows"].alias("_rows"), F.coalesce(before(i, "_rows"), F.lit(0)).alias("_rows_before"),
            *(before(i, f"_sum_{n}").alias(f"_sum_before_{n}") for n in running),
            *(F.get("_list", i - 1)[f"_last_{n}"].alias(f"_last_before_{n}") for n in previous),
            *(F.get("_list", i + 1)[f"_first_{n}"].alias(f"_first_after_{n}") for n in following),
        )

    return gathered.select(*(F.col(k).alias(f"_r{k}") for k in keys), F.inline(F.transform("_list", line)))


def quantile_sketch(df: DataFrame, columns: list[str], probabilities: list[float], accuracy: int = 10_000) -> DataFrame:
    """One row with a struct per column: count, missing, lowest, mean, highest, and a bracket per probability.

    A bracket holds the quantile for certain: its ends are sketched values a few errors of the
    sketch off, moved on to the next sketched value that differs, or to infinity where there is none.
    """
    margin = 5.0 / accuracy
    spread = [margin * 2**j for j in range(accuracy.bit_length())]
    wanted = [min(1.0, max(0.0, p + sign * s)) for p in probabilities for sign in (-1, 1) for s in spread]
    numbers = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    raw = numbers.agg(*(
        F.struct(
            F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("missing"), F.min(c).alias("lowest"), F.avg(c).alias("mean"),
            F.max(c).alias("highest"), F.percentile_approx(c, wanted, accuracy).alias("near"),
        ).alias(c) for c in columns
    ))

    def brackets(near: Column) -> Column:
        def end(k: int, low: bool) -> Column:
            values = F.slice(near, k * len(spread) + 1, len(spread))
            first = F.get(near, F.lit(k * len(spread)))
            if low:
                return F.coalesce(F.array_max(F.filter(values, lambda v: v < first)), F.lit(float("-inf")))
            return F.coalesce(F.array_min(F.filter(values, lambda v: v > first)), F.lit(float("inf")))
        return F.array(*(F.struct(end(2 * i, True).alias("low"), end(2 * i + 1, False).alias("high")) for i in range(len(probabilities))))

    return raw.select(*(
        F.struct(*(F.col(c)[f].alias(f) for f in ("n", "missing", "lowest", "mean", "highest")), brackets(F.col(c)["near"]).alias("brackets")).alias(c)
        for c in columns
    ))


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], accuracy: int = 10_000, sketch: DataFrame | None = None
) -> DataFrame:
    """Exact quantiles (linear interpolation) per column, as rows of
    ``column_name, probability, quantile``.

    Two passes over ``df``, whatever the number of columns and probabilities: a sketch brackets
    each rank (or is given, from ``quantile_sketch``), then one aggregation counts the values below and above
    every bracket and groups those inside. Only these are ordered, in ranges, so no task holds a whole column.
    """
    found = checkpointed(quantile_sketch(df, columns, probabilities, accuracy)) if sketch is None else sketch
    numbers = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    known = found.select(F.struct(*columns).alias("s")).scalar()
    each = range(len(probabilities))

    def zones(c: str) -> Column:
        """Per probability -1 below its bracket, 0 inside and 1 above; the value where it is inside of one."""
        ends = F.col("_sketch")[c]["brackets"]
        sides = [F.when(F.col(c) < F.get(ends, F.lit(i))["low"], -1).when(F.col(c) > F.get(ends, F.lit(i))["high"], 1).otherwise(0) for i in each]
        inside = reduce(Column.__or__, (s == 0 for s in sides))
        return F.when(F.col(c).isNotNull(), F.struct(
            F.lit(c).alias("column_name"), *(s.cast("byte").alias(f"side{i}") for i, s in enumerate(sides)), F.when(inside, F.col(c)).alias("v"),
        ))

    lines = numbers.withColumn("_sketch", known).select(F.explode(F.array(*(zones(c) for c in columns))).alias("z")).where(F.col("z").isNotNull()).select("z.*")
    counted = checkpointed(lines.groupBy(*lines.columns).agg(F.count(F.lit(1)).alias("c")))
    per_rank = counted.select("column_name", "v", "c", F.inline(F.array(*(
        F.struct(F.lit(p).alias("probability"), F.col(f"side{i}").alias("side")) for i, p in enumerate(probabilities)
    ))))
    totals = per_rank.groupBy("column_name", "probability").agg(
        F.sum("c").alias("n"), F.coalesce(F.sum(F.when(F.col("side") < 0, F.col("c"))), F.lit(0)).alias("below")
    )
    run = ordered_columns(per_rank.where("side = 0"), ["column_name", "probability"], ["v"], running={"upto": "c"})
    target = (F.col("n") - 1) * F.col("probability")
    base = F.floor(target)
    after = F.col("below") + F.col("upto")
    before = after - F.col("c")

    def value_at(rank: Column) -> Column:
        return F.max(F.when((before <= rank) & (rank < after), F.col("v")))

    picked = run.join(totals, ["column_name", "probability"]).groupBy("column_name", "probability").agg(
        value_at(base).alias("v0"),
        value_at(F.least(base + 1, F.col("n") - 1)).alias("v1"),
        F.max(target - base).alias("part"),
    )
    return picked.select(
        "column_name", "probability",
        (F.col("v0") + F.col("part") * (F.col("v1") - F.col("v0"))).alias("quantile"),
    )
