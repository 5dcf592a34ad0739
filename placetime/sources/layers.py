"""Spatial layers as parquet tables with well-known-binary points."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_POINT = np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])


def point_wkb(lon: Column | str, lat: Column | str) -> Column:
    """Little-endian well-known binary of a point."""

    @F.pandas_udf("binary")
    def encode(x: pd.Series, y: pd.Series) -> pd.Series:
        block = np.empty(len(x), dtype=_POINT)
        block["order"], block["kind"], block["x"], block["y"] = 1, 1, x, y
        raw = block.tobytes()
        return pd.Series([raw[i:i + _POINT.itemsize] for i in range(0, len(raw), _POINT.itemsize)])

    return encode(lon, lat)


def wkb_point(wkb: Column | str) -> Column:
    """Coordinates of a well-known-binary point."""

    @F.pandas_udf("lon double, lat double")
    def decode(values: pd.Series) -> pd.DataFrame:
        block = np.frombuffer(b"".join(values), dtype=_POINT)
        return pd.DataFrame({"lon": block["x"], "lat": block["y"]})

    return decode(wkb)


def _pointers(root: str, layer: str) -> str:
    return f"{root}/{layer}/pointers"


def current_version(spark: SparkSession, root: str, layer: str) -> tuple[int, str] | None:
    """Number and folder of the version that readers see; None where nothing was written."""
    try:
        rows = spark.read.schema("number long, version string").json(_pointers(root, layer))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = rows.agg(F.max(F.struct("number", "version")).alias("last")).first()["last"]
    return (last["number"], last["version"]) if last else None


def write_layer(df: DataFrame, root: str, layer: str, geom: str = "geom") -> None:
    """Replace a layer: the geometry becomes binary, all other columns stay.

    The rows go to a folder of their own. Only when all are written is a pointer of one row added, and
    the pointer with the highest number counts, so readers see the old layer or the new one and never a part; a
    write that fails leaves the old one. Of writers at the same time the last name wins. Old folders stay
    until they are removed, for readers that have started.
    """
    spark = df.sparkSession
    before = current_version(spark, root, layer)
    version = uuid.uuid4().hex
    stored = df.withColumn(geom, point_wkb(F.col(geom)["lon"], F.col(geom)["lat"]))
    stored.write.parquet(f"{root}/{layer}/versions/{version}")
    number = before[0] + 1 if before else 0
    spark.createDataFrame([(number, version)], "number long, version string").coalesce(1).write.mode("append").json(_pointers(root, layer))


def read_layer(spark: SparkSession, root: str, layer: str, geom: str = "geom") -> DataFrame:
    """The layer as it was last replaced."""
    now = current_version(spark, root, layer)
    if now is None:
        raise LookupError(f"no layer {layer!r} below {root}")
    return spark.read.parquet(f"{root}/{layer}/versions/{now[1]}").withColumn(geom, wkb_point(geom))
