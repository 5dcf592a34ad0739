"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"  # fixed value: the characters that separate words


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores until no column of ``df`` has the name, letter case aside."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def every(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by name, whatever the names contain."""
    return [F.col(quoted(c)) for c in df.columns]
