"""Flat files: CSV with header, dataset releases, JSON documents, literal tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT_SCHEMA = T.StructType([
    T.StructField(name, T.StringType()) for name in ("objectID", "href", "title", "section", "text")
])
REGION_SCHEMA = T.StructType([
    T.StructField(name, T.StringType()) for name in ("State", "State Code", "Region", "Division")
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and a stated schema; ``NA`` is a missing value."""
    return (
        spark.read.schema(schema).option("header", True).option("nullValue", "NA")
        .option("enforceSchema", False).csv(path)
    )


def read_documents(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """Search documents: one object per line, or whole-file arrays.

    An array file cannot be split, so one file is one task; large sets belong in lines.
    """
    return spark.read.schema(DOCUMENT_SCHEMA).option("multiLine", array_file).json(path)


# --- dataset releases -------------------------------------------------------------

def write_release(tables: dict[str, DataFrame], root: str, release: str) -> None:
    """Store a bundle of named tables under ``root/release=<date>/<table>``."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/release={release}/{name}")


def release_date(manifest: DataFrame, year: int, week: int) -> str:
    """Release date of a (year, week); the manifest has one row per release and table."""
    row = manifest.where((F.col("year") == year) & (F.col("week") == week)).select(F.max("release")).first()
    if row is None or row[0] is None:
        raise LookupError(f"no release for week {week} of {year}")
    return str(row[0])


def manifest_rows(spark: SparkSession, release: str, tables: list[str]) -> DataFrame:
    """Manifest rows of a release."""
    day = dt.date.fromisoformat(release)
    year, week, _ = day.isocalendar()
    rows = [(release, year, week, name) for name in tables]
    return spark.createDataFrame(rows, "release string, year int, week int, table_name string")


def load_release(
    spark: SparkSession, root: str, manifest: DataFrame, date: str | None = None,
    year: int | None = None, week: int | None = None,
) -> dict[str, DataFrame]:
    """Tables of one release, addressed by date or by year and week."""
    release = date or release_date(manifest, year, week)
    # table names of one release: a handful
    names = [r["table_name"] for r in manifest.where(F.col("release") == release).select("table_name").distinct().collect()]
    if not names:
        raise LookupError(f"no release {release}")
    return {name: spark.read.parquet(f"{root}/release={release}/{name}") for name in names}


def pick_table(bundle: dict[str, DataFrame], name: str) -> DataFrame:
    if name not in bundle:
        raise LookupError(f"no table {name!r}; the release has {sorted(bundle)}")
    return bundle[name]


def literal_table(spark: SparkSession, values: dict[str, float], key: str, value: str) -> DataFrame:
    """A named vector as a two-column table."""
    return spark.createDataFrame(list(values.items()), f"{key} string, {value} double")


def region_columns(df: DataFrame) -> list[Column]:
    """Region dimension under names without spaces."""
    return [F.col(f"`{c}`").alias(c.lower().replace(" ", "_")) for c in df.columns]
