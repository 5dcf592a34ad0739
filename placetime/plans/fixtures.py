"""Tables derived from the given ones, in Spark and as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placetime.functions import geo, shapes
from placetime.operators.ordered import ordered_columns
from placetime.operators.spatial import extent
from placetime.plans.registry import documents, table

POINTS_SQL = """
points AS (
  SELECT event_id, user_id, event_type, ts, value,
         24.5e0 + ((event_id * 7919) % 25000) / 1000e0 AS lat,
         -125e0 + ((event_id * 104729) % 58000) / 1000e0 AS lon
  FROM events
)"""

BOXES_SQL = """
boxes AS (
  SELECT n_nationkey AS box_id,
         25e0 + (n_nationkey % 5) * 4 AS south, -120e0 + n_nationkey * 2 AS west,
         28e0 + (n_nationkey % 5) * 4 AS north, -116e0 + n_nationkey * 2 AS east
  FROM nation
)"""

SEARCH_DOCS_SQL = """
docs AS (
  SELECT doc_id,
         concat('p', doc_id // 4, '.html', CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat('#s', doc_id % 4) END) AS href,
         source AS title, lang AS section, text
  FROM documents
)"""

ASKED_SQL = """
asked AS (SELECT item_id AS query_id, substr(text, 11, 12) AS query FROM benchmark)"""

EXTENTS_SQL = """
extents AS (
  SELECT user_id, min(lat) AS south, min(lon) AS west, max(lat) AS north, max(lon) AS east
  FROM points GROUP BY user_id
)"""

NUMBERED_SQL = """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM points
), tracked AS (SELECT * FROM numbered)"""


def points(spark: SparkSession, folder: str) -> DataFrame:
    """Events with made-up coordinates that follow from the event id."""
    event = F.col("event_id")
    return table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", "ts", "value",
        (F.lit(24.5) + ((event * 7919) % 25000) / 1000.0).alias("lat"),
        (F.lit(-125.0) + ((event * 104729) % 58000) / 1000.0).alias("lon"),
    )


def boxes(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("n_nationkey")
    south, west = 25.0 + (n % 5) * 4, -120.0 + n * 2
    return table(spark, folder, "nation").select(
        n.alias("box_id"), geo.box(south, west, south + 3, west + 4).alias("box")
    )


def extents(spark: SparkSession, folder: str) -> DataFrame:
    return extent(points(spark, folder), ["user_id"])


def search_documents(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.col("doc_id")
    anchor = F.when(doc % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("#s"), doc % 4))
    return documents(spark, folder).select(
        "doc_id", F.concat(F.lit("p"), F.expr("doc_id div 4"), F.lit(".html"), anchor).alias("href"),
        F.col("source").alias("title"), F.col("lang").alias("section"), "text",
    )


def asked(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.substring("text", 11, 12).alias("query")
    )


def numbered_points(spark: SparkSession, folder: str) -> DataFrame:
    """Points with their position in the track of their user."""
    return ordered_columns(
        points(spark, folder), ["user_id"], ["ts", "event_id"], rank="pos"
    )


def tracks(spark: SparkSession, folder: str) -> DataFrame:
    """Line features: the whole track of a user."""
    vertices = F.array_sort(F.collect_list(F.struct("ts", "event_id", "lon", "lat")))
    return (
        points(spark, folder).groupBy("user_id").agg(vertices.alias("v"))
        .select("user_id", F.transform("v", lambda v: shapes.vertex(v["lon"], v["lat"])).alias("line"))
    )


def polygons(spark: SparkSession, folder: str) -> DataFrame:
    """Per box: the box with a triangle cut out of it, and the triangle itself."""
    b = F.col("box")

    def ring(*corners) -> F.Column:
        return F.array(*(shapes.vertex(x, y) for x, y in corners))

    outer = ring(
        (b["west"], b["south"]), (b["east"], b["south"]), (b["east"], b["north"]), (b["west"], b["north"])
    )
    triangle = ring(
        (b["west"] + 0.5, b["south"] + 0.5), (b["west"] + 3.1, b["south"] + 0.7), (b["west"] + 1.3, b["south"] + 2.6)
    )
    return boxes(spark, folder).select(
        "box_id",
        F.explode(F.array(
            F.struct(F.lit("frame").alias("kind"), F.array(outer, triangle).alias("rings")),
            F.struct(F.lit("triangle").alias("kind"), F.array(triangle).alias("rings")),
        )).alias("p"),
    ).select("box_id", "p.*")


POLYGON_SIDES_SQL = """
rings AS (
  SELECT box_id, 'frame' AS kind, 0 AS ring,
         [[west, south], [east, south], [east, north], [west, north]] AS v FROM boxes
  UNION ALL
  SELECT box_id, k.kind, 1 AS ring,
         [[west + 0.5e0, south + 0.5e0], [west + 3.1e0, south + 0.7e0], [west + 1.3e0, south + 2.6e0]] AS v
  FROM boxes CROSS JOIN (VALUES ('frame'), ('triangle')) AS k(kind)
), sides AS (
  SELECT box_id, kind, ring, i,
         v[CASE WHEN i = 1 THEN len(v) ELSE i - 1 END][1] AS ax, v[CASE WHEN i = 1 THEN len(v) ELSE i - 1 END][2] AS ay,
         v[i][1] AS bx, v[i][2] AS b_y
  FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM rings)
)"""
