"""Small value-level functions: dates, noise, arrays, option maps."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_day(value: Column | str, numeric: bool = False) -> Column:
    """Date without the time of day; numbers count days from 1970-01-01."""
    if numeric:
        return F.date_add(F.lit("1970-01-01").cast("date"), _c(value).cast("int"))
    return F.to_date(_c(value))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a computed value several times in an expression, computing it once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


_EPOCH = "1970-01-01 00:00:00"


def micros(value: Column | str, kind: str) -> Column:
    """Microseconds since 1970 of a ``timestamp`` or ``timestamp_ntz`` column."""
    if kind == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast(kind), _c(value))
    return F.unix_micros(_c(value))


def from_micros(value: Column | str, kind: str) -> Column:
    if kind == "timestamp_ntz":
        return F.timestamp_add("MICROSECOND", _c(value), F.lit(_EPOCH).cast(kind))
    return F.timestamp_micros(_c(value))


def jitter(value: Column | str, amount: float, key: Column | str, seed: int = 0) -> Column:
    """Add uniform noise in [-amount, amount), fixed by the key, so that neither
    partitioning nor a retried task changes it. The noise is the first 52 bits of an
    MD5 of key and seed; a null key is the empty text."""
    digest = F.md5(F.concat(F.coalesce(_c(key).cast("string"), F.lit("")), F.lit(f":{seed}")))
    unit = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)
    return _c(value) + (unit * 2 - 1) * amount


def time_bucket(
    day: Column | str, first_year: int, last_year: int, width: int = 10, bounds: str = "closed_left"
) -> Column:
    """Label a date with its slice ``start-end``; ``before`` and ``after`` lie outside.

    ``closed_left`` puts a boundary date in the later slice; ``open`` gives it no
    slice at all, and ``last_year`` then has no ``after`` slice either.
    """
    if bounds not in ("closed_left", "open"):
        raise ValueError("bounds is closed_left or open")
    day = _c(day)
    year = F.year(day)
    start = first_year + F.floor((year - first_year) / width).cast("int") * width
    label = (
        F.when(year < first_year, F.lit("before"))
        .when(year >= last_year, F.lit("after"))
        .otherwise(F.concat_ws("-", start, start + width))
    )
    if bounds == "closed_left":
        return label
    first_instant = F.make_timestamp(start, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    on_boundary = (day.cast("timestamp") == first_instant) & (year >= first_year)
    return F.when(~on_boundary, label)


def recycle(values: list, position: Column | str) -> Column:
    """Repeat a short list of values over a 0-based row position."""
    array = F.array(*map(F.lit, values))
    return F.element_at(array, (_c(position) % len(values) + 1).cast("int"))


def decode(dictionary: Column | list, code: Column | str) -> Column:
    """Value behind a 0-based dictionary code; null outside the dictionary."""
    array = F.array(*map(F.lit, dictionary)) if isinstance(dictionary, list) else dictionary
    code = _c(code).cast("int")
    return F.when((code >= 0) & (code < F.size(array)), F.get(array, code))


def transpose(matrix: Column | str) -> Column:
    """Swap rows and columns of an array of equally long arrays."""
    matrix = _c(matrix)
    columns = F.sequence(F.lit(0), F.size(F.get(matrix, F.lit(0))) - 1)
    return F.when(F.size(matrix) == 0, matrix).otherwise(
        F.transform(columns, lambda i: F.transform(matrix, lambda row: F.get(row, i)))
    )


def zip_rows(**arrays: Column | str) -> Column:
    """Array of row structs from equally long named arrays; unequal lengths fail."""
    columns = {name: _c(array) for name, array in arrays.items()}
    first = next(iter(columns.values()))
    equal = F.lit(True)
    for array in columns.values():
        equal = equal & F.equal_null(F.size(array), F.size(first))
    # the check sits on an argument, so that no optimizer rule can drop it
    checked = F.when(equal, first).otherwise(
        F.raise_error(F.lit("all fields must be arrays of the same length"))
    )
    named = [checked.alias(name) if i == 0 else array.alias(name)
             for i, (name, array) in enumerate(columns.items())]
    return F.arrays_zip(*named)


def chunks(items: Column | str, size: int = 20) -> Column:
    """Cut an array in consecutive pieces of at most ``size`` items."""
    items = _c(items)
    count = F.ceil(F.size(items) / size).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.slice(items, i * size + 1, F.lit(size)),
    )
    return F.when(F.size(items) > 0, pieces)


def merge_options(*maps: Column | str) -> Column:
    """Merge option maps; a later map wins, a null map counts as empty."""
    def over(earlier: Column, later: Column) -> Column:
        kept = F.map_filter(earlier, lambda key, _value: ~F.map_contains_key(later, key))
        return F.map_concat(kept, later)

    empty = F.create_map().cast("map<string,string>")
    return reduce(over, (F.coalesce(_c(column), empty) for column in maps))


def ramp(position: Column | str, count: Column | str, low: float, high: float) -> Column:
    """Evenly spaced value for a 1-based position among ``count``."""
    steps = F.greatest(_c(count) - 1, F.lit(1))
    return low + (_c(position) - 1) * (high - low) / steps
