"""GeoJSON in and out, one document or feature per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetime.session import checkpointed

# Geometry types with the nesting of their coordinates, and decimals kept.
COORDINATE_DEPTH = {
    "Point": 0,
    "MultiPoint": 1,
    "LineString": 1,
    "MultiLineString": 2,
    "Polygon": 2,
    "MultiPolygon": 3,
}
DECIMALS = 6

_GEOMETRY = "struct<type:string,coordinates:string,geometries:array<string>>"
_NODE = (
    f"struct<type:string,id:string,features:array<string>,geometry:{_GEOMETRY},"
    "properties:map<string,string>,coordinates:string,geometries:array<string>,"
    "_bad:string>"
)


def _parsed(df: DataFrame, text: str) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    return df.withColumn("_node", F.from_json(text, _NODE, options))


def bad_documents(df: DataFrame, text: str) -> DataFrame:
    """Rows whose text is not a JSON object: the reject table."""
    return _parsed(df, text).where(F.col("_node").isNull() | F.col("_node._bad").isNotNull()).drop("_node")


def _some(df: DataFrame) -> bool:
    return df.limit(1).count() > 0


def read_features(
    df: DataFrame, text: str, keep: list[str] | None = None, only: Column | None = None, each: dict[str, Column] | None = None,
) -> DataFrame:
    """Flatten GeoJSON texts of any depth to one row per geometry.

    Gives ``keep`` columns, ``feature_id``, ``geometry_type``, ``coordinates`` (JSON
    text) and ``properties``. Members of a geometry collection keep the feature's
    properties. Features without geometry are skipped. An unknown geometry type fails.
    ``only`` filters and ``each`` adds columns per feature. Texts that are no JSON object are left to
    :func:`bad_documents`.

    Collections are opened in rounds over the nodes that still hold others. The
    first round is part of the plan; whether there is another depends on the data.
    """
    keep = keep or []
    node = F.col("_node")

    def opened(nodes: DataFrame) -> DataFrame:
        members = F.transform(node["features"], lambda item: F.from_json(item, _NODE))
        inner = F.when(node["features"].isNull(), F.array(node)).otherwise(members)
        # outer explodes and written nodes: a filter on a parsed column would parse it twice
        return nodes.select(*keep, F.explode_outer(inner).alias("_node"))

    nodes = checkpointed(opened(_parsed(df.select(*keep, text), text).select(*keep, "_node")))
    frontier = nodes.where(node["features"].isNotNull())
    nodes = nodes.where(node["features"].isNull())
    while _some(frontier):
        inner = checkpointed(opened(frontier))
        nodes, frontier = nodes.union(inner.where(node["features"].isNull())), inner.where(node["features"].isNotNull())

    bare = F.when(
        node["coordinates"].isNotNull() | node["geometries"].isNotNull(),
        F.struct(*(node[part].alias(part) for part in ("type", "coordinates", "geometries"))),
    )
    geometry = F.col("geometry")
    flat = nodes.select(
        *keep, node["id"].alias("feature_id"),
        F.coalesce(node["properties"], F.create_map().cast("map<string,string>")).alias("properties"),
        F.coalesce(node["geometry"], bare).alias("geometry"), node["_bad"].alias("_bad"),
    ).where(F.col("_bad").isNull()).drop("_bad").where(geometry["coordinates"].isNotNull() | geometry["geometries"].isNotNull())
    if only is not None:
        flat = flat.where(only)

    def taken_apart(features: DataFrame) -> DataFrame:
        members = F.transform(geometry["geometries"], lambda item: F.from_json(item, _GEOMETRY))
        return features.withColumn("geometry", F.explode(members))

    collection = F.coalesce(geometry["type"] == "GeometryCollection", F.lit(False))
    frontier, flat = flat.where(collection), flat.where(~collection)
    while _some(frontier):
        inner = checkpointed(taken_apart(frontier))
        flat, frontier = flat.union(inner.where(~collection)), inner.where(collection)

    kind = geometry["type"]
    checked = F.when(kind.isin(list(COORDINATE_DEPTH)), kind).otherwise(
        F.raise_error(F.concat(F.lit("invalid GeoJSON type "), F.coalesce(kind, F.lit("null")))).cast("string")
    )
    out = flat.select(
        *keep, "feature_id", checked.alias("geometry_type"), geometry["coordinates"].alias("coordinates"), "properties"
    )
    return out.withColumns(each) if each else out


def coordinates(geometry_type: str, column: Column | str = "coordinates") -> Column:
    """Coordinate text as nested arrays of the depth the type asks for."""
    shape = "double"
    for _ in range(COORDINATE_DEPTH[geometry_type] + 1):
        shape = f"array<{shape}>"
    return F.from_json(column, shape)


def round_half_up(value: Column, decimals: int = DECIMALS) -> Column:
    """Round halves towards plus infinity."""
    factor = float(10**decimals)
    return F.floor(value * factor + 0.5) / factor


def position(lon: Column, lat: Column, alt: Column | None = None) -> Column:
    parts = [round_half_up(lon), round_half_up(lat)]
    return F.array(*parts) if alt is None else F.array(*parts, round_half_up(alt))


def line_positions(line: Column | str) -> Column:
    line = F.col(line) if isinstance(line, str) else line
    return F.transform(line, lambda v: position(v["x"], v["y"]))


def ring_positions(ring: Column | str) -> Column:
    """Ring coordinates, closed by repeating the first point."""
    open_ring = line_positions(ring)
    return F.concat(open_ring, F.slice(open_ring, F.lit(1), F.lit(1)))


def feature(geometry_type: str, coordinates_: Column, properties: Column | None = None) -> Column:
    """One GeoJSON feature as text."""
    geometry = F.struct(F.lit(geometry_type).alias("type"), coordinates_.alias("coordinates"))
    properties = properties if properties is not None else F.create_map().cast("map<string,string>")
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry")
    ))


def feature_collection(features: Column) -> Column:
    """A collection text from an array of feature texts."""
    return F.concat(
        F.lit('{"type":"FeatureCollection","features":['), F.array_join(features, ","), F.lit("]}")
    )


def write_features(df: DataFrame, column: str, path: str) -> None:
    """One feature per line, in as many files as the data has partitions."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)
