"""Preparing event and place tables: subset, join, de-duplicate, slice in time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetime.functions import geo, values

SRID = 4326  # fixed value: longitude/latitude on WGS 84


def first_columns(df: DataFrame, count: int) -> DataFrame:
    return df.select(df.columns[:count])


def only_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows where the column equals the value; a missing value drops the row."""
    return df.where(F.col(column) == F.lit(value))


def dropped_by_missing(df: DataFrame, column: str) -> DataFrame:
    """How many rows an equality filter drops only because the value is missing."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("dropped"))


def between_open(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows strictly inside (low, high); either end may be missing."""
    c = F.col(column)
    if low is not None:
        df = df.where(c > F.lit(low))
    if high is not None:
        df = df.where(c < F.lit(high))
    return df


def with_points(df: DataFrame, lon: str = "lon", lat: str = "lat", into: str = "geom") -> DataFrame:
    """Replace two coordinate columns by a point column and its reference system."""
    made = df.withColumns({into: geo.point(lon, lat), "srid": F.lit(SRID)})
    return made.drop(lon, lat)


def with_coordinates(df: DataFrame, geom: str = "geom") -> DataFrame:
    return df.withColumns({"lon": F.col(f"{geom}.lon"), "lat": F.col(f"{geom}.lat")})


def complete_rows(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def valid_coordinates(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose named columns all read as numbers."""
    return df.where(reduce(Column.__and__, (geo.is_coordinate(c) for c in columns)))


def merge_tables(left: DataFrame, right: DataFrame, on: list[str], null_safe: bool = False) -> DataFrame:
    """Inner many-to-many join; clashing columns get ``_x`` and ``_y``, keys come first."""
    clash = (set(left.columns) & set(right.columns)) - set(on)
    a = left.withColumnsRenamed({c: f"{c}_x" for c in clash})
    b = right.withColumnsRenamed({c: f"{c}_y" for c in clash})
    rest = [c for c in a.columns + b.columns if c not in on]
    if not null_safe:
        return a.join(b, on, "inner").select(*on, *rest)
    keyed = b.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(Column.__and__, (a[c].eqNullSafe(keyed[f"_right_{c}"]) for c in on))
    return a.join(keyed, same, "inner").select(*on, *rest)


def sorted_merge(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """:func:`merge_tables` with the rows in key order, for final output only."""
    return merge_tables(left, right, on).orderBy(*on)


def lookup(df: DataFrame, dimension: DataFrame, on: list[str]) -> DataFrame:
    """Left join to a dimension; Spark broadcasts it when its measured size allows."""
    return df.join(dimension, on, "left")


def first_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One whole row per key: the first in the order, ties settled by all other columns.

    A minimum over structs combines on the map side, so a hot key shuffles one row
    per task instead of all its rows.
    """
    order = order or []
    rest = [c for c in df.columns if c not in order and c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return best.select(*(F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns))


def extremes(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.min(c).alias("lowest"), F.max(c).alias("highest"), F.count_if(c.isNull()).alias("missing")
    )


def label_slices(
    df: DataFrame, column: str, first_year: int, last_year: int, width: int,
    bounds: str = "closed_left", into: str = "slice",
) -> DataFrame:
    """All time slices of a table as one labelled table, in one pass."""
    label = values.time_bucket(column, first_year, last_year, width, bounds)
    return df.withColumn(into, label)


def slice_counts(df: DataFrame, column: str, first_year: int, last_year: int, width: int,
                 bounds: str = "closed_left") -> DataFrame:
    labelled = label_slices(df.select(column), column, first_year, last_year, width, bounds)
    return labelled.where(F.col("slice").isNotNull()).groupBy("slice").agg(
        F.count(F.lit(1)).alias("points")
    )


def labelled_union(slices: dict[str, DataFrame], into: str = "slice") -> DataFrame:
    """Stack tables of one shape under their names."""
    named = [df.withColumn(into, F.lit(name)) for name, df in slices.items()]
    return reduce(DataFrame.unionByName, named)


def show_groups(df: DataFrame, group: str, shown: list[str]) -> DataFrame:
    return df.where(F.col(group).isin(shown))


def show_base_group(df: DataFrame, group: str, base_groups: list[str], visible: list[str]) -> DataFrame:
    """Of the base groups only the first visible one stays; other groups are untouched."""
    first = next((g for g in base_groups if g in visible), None)
    gone = [g for g in base_groups if g != first]
    return df.where(F.col(group).isNull() | ~F.col(group).isin(gone)) if gone else df


def time_range(df: DataFrame, column: str, low, high, tie: list[str]) -> DataFrame:
    """Rows between two slider handles, both included, in time order."""
    c = F.col(column)
    return df.where(c.between(F.lit(low), F.lit(high))).orderBy(column, *tie)


def time_steps(df: DataFrame, column: str, low, high, step: str = "month") -> DataFrame:
    """Points per calendar step inside the slider range."""
    c = F.col(column)
    return (
        df.where(c.between(F.lit(low), F.lit(high)))
        .groupBy(F.date_trunc(step, c).cast("date").alias("step"))
        .agg(F.count(F.lit(1)).alias("points"))
    )
