"""Array columns to rows.

Spark adds a size test below an inner explode, which computes the array a second time.
The outer form has no such test; the row it adds for an empty array is dropped after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetime.functions import text, values


def exploded(df: DataFrame, array: Column, keep: list[str], pos: str, item: str) -> DataFrame:
    """One row per array element with its 0-based position."""
    rows = df.select(*keep, F.posexplode_outer(array).alias(pos, item))
    return rows.where(F.col(pos).isNotNull())


def tokens(df: DataFrame, column: str, keep: list[str], pattern: str = text.TURTLE_TOKENS) -> DataFrame:
    """One row per match of a pattern, in order."""
    return exploded(df, text.extract_tokens(column, pattern), keep, "pos", "token")


def zipped(df: DataFrame, keep: list[str], **arrays: Column | str) -> DataFrame:
    """One row per position of equally long arrays; unequal lengths fail the job."""
    return exploded(df, values.zip_rows(**arrays), keep, "pos", "_row").select(*keep, "_row.*")
