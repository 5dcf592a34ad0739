"""Throttled events, batches, and tables written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from placetime.operators import events, prep
from placetime.plans.fixtures import POINTS_SQL, points, search_documents
from placetime.plans.registry import documents, query, table
from placetime.session import fresh_path
from placetime.sources import layers, tables
from placetime.streaming.throttle import run_to_table, throttle_stream

_WAIT_HOURS = 12
_WAIT_MS = _WAIT_HOURS * 3_600_000

_THROTTLE_SQL = f"""
WITH RECURSIVE instants AS (
  SELECT user_id, ts, min(event_id) AS event_id FROM events GROUP BY 1, 2
), linked AS (
  SELECT a.user_id, a.ts, a.event_id, b.ts AS next_ts
  FROM (SELECT *, ts + INTERVAL {_WAIT_HOURS} HOUR AS open_at FROM instants) a
  ASOF LEFT JOIN instants b ON a.user_id = b.user_id AND a.open_at <= b.ts
), kept AS (
  SELECT user_id, ts, event_id, next_ts FROM linked l
  WHERE ts = (SELECT min(ts) FROM instants i WHERE i.user_id = l.user_id)
  UNION ALL
  SELECT l.user_id, l.ts, l.event_id, l.next_ts FROM kept k JOIN linked l ON l.user_id = k.user_id AND l.ts = k.next_ts
)
SELECT user_id, ts, event_id FROM kept
"""


@query(_THROTTLE_SQL)
def throttled_events(spark, sf):
    return events.throttle(table(spark, sf, "events"), "user_id", "ts", "event_id", _WAIT_MS)


@query(_THROTTLE_SQL)
def throttled_stream(spark, sf):
    """The same throttle as a stream over the events table, drained to a table."""
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/events.parquet*")
    kept = throttle_stream(stream, "user_id", "ts", "event_id", _WAIT_MS)
    done = run_to_table(kept, fresh_path(spark, "throttled"), fresh_path(spark, "throttled-state"))
    return done.select("user_id", "ts", "event_id")


@query("""
SELECT doc_id, CAST(batch AS INTEGER) AS batch, len(words[batch * 20 + 1:batch * 20 + 20]) AS items,
       array_to_string(words[batch * 20 + 1:batch * 20 + 20], ' ') AS joined
FROM (SELECT doc_id, words, unnest(range(CAST(ceil(len(words) / 20) AS BIGINT))) AS batch
      FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents))
""")
def item_batches(spark, sf):
    docs = documents(spark, sf).select("doc_id", F.split("text", " ").alias("items"))
    return events.batches(docs, "items").select(
        "doc_id", "batch", F.size("items").cast("bigint").alias("items"), F.array_join("items", " ").alias("joined")
    )


# --- tables written and read back ----------------------------------------------------

@query("""
SELECT n_name AS state, CAST(n_nationkey AS VARCHAR) AS state_code, nullif(r_name, 'ASIA') AS region, count(c_custkey) AS customers
FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL
""")
def csv_dimension(spark, sf):
    """A region dimension stored as CSV with a header, read with a schema and looked up."""
    path = fresh_path(spark, "regions")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("State"), F.col("n_nationkey").cast("string").alias("State Code"),
        F.when(F.col("r_name") != "ASIA", F.col("r_name")).otherwise("NA").alias("Region"), F.lit("none").alias("Division"),
    ).write.option("header", True).csv(path)
    stored = tables.read_csv(spark, path, tables.REGION_SCHEMA)
    dimension = stored.select(*tables.region_columns(stored))
    counts = table(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("string").alias("state_code")).agg(F.count(F.lit(1)).alias("customers"))
    return prep.lookup(dimension, counts, ["state_code"]).select(
        "state", "state_code", "region", F.coalesce("customers", F.lit(0)).alias("customers")
    )


@query("""
SELECT c_mktsegment, count(*) AS sightings, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def release_tables(spark, sf):
    """A release stored once, then loaded by year and week."""
    root, day = fresh_path(spark, "releases"), "2024-03-14"
    bundle = {
        "sightings": table(spark, sf, "orders").select("o_custkey", "o_totalprice"),
        "places": table(spark, sf, "customer").select("c_custkey", "c_mktsegment"),
    }
    tables.write_release(bundle, root, day)
    manifest = tables.manifest_rows(spark, day, list(bundle))
    loaded = tables.load_release(spark, root, manifest, year=2024, week=11)
    sightings, places = tables.pick_table(loaded, "sightings"), tables.pick_table(loaded, "places")
    joined = sightings.join(places, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("sightings"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""
SELECT concat('p', doc_id // 4, '.html', CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat('#s', doc_id % 4) END) AS href,
       source AS title, lang AS section, md5(text) AS digest FROM documents
""")
def json_documents(spark, sf):
    """Search documents stored as JSON lines and read with their schema."""
    path = fresh_path(spark, "documents")
    search_documents(spark, sf).select(
        F.col("href").alias("objectID"), "href", "title", "section", "text"
    ).write.json(path)
    stored = tables.read_documents(spark, path)
    return stored.select("href", "title", "section", F.md5(F.col("text").cast("binary")).alias("digest"))


_ARRAY = 500


@query("""
SELECT doc_id // 500 AS part, concat('p', doc_id // 4, '.html', CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat('#s', doc_id % 4) END) AS href,
       source AS title, lang AS section, md5(text) AS digest FROM documents
""")
def json_array_documents(spark, sf):
    """Search documents stored as files of one JSON array each, 500 documents to a file, and read with their schema."""
    path = fresh_path(spark, "document-arrays")
    docs = search_documents(spark, sf).withColumn("part", F.floor(F.col("doc_id") / _ARRAY))
    one = F.to_json(F.struct(F.col("href").alias("objectID"), "href", "title", "section", "text"))
    arrays = docs.groupBy("part").agg(F.concat(F.lit("["), F.array_join(F.collect_list(one), ",\n"), F.lit("]")).alias("value"))
    arrays.write.partitionBy("part").text(path)
    stored = tables.read_documents(spark, path, array_file=True)
    return stored.select(F.col("part").cast("bigint").alias("part"), "href", "title", "section", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(f"WITH {POINTS_SQL} SELECT event_id, lon, lat, 4326 AS srid FROM points")
def stored_layer(spark, sf):
    """A spatial layer written twice under one name, then read back from its binary points."""
    root = fresh_path(spark, "layers")
    made = prep.with_points(points(spark, sf))
    layers.write_layer(made.where(F.col("event_type") == "click"), root, "event_points")
    layers.write_layer(made, root, "event_points")
    stored = layers.read_layer(spark, root, "event_points")
    return prep.with_coordinates(stored).select("event_id", "lon", "lat", "srid")


@query("""
SELECT o_orderpriority, s.share, count(*) AS orders FROM orders
JOIN (VALUES ('1-URGENT', 0.35e0), ('2-HIGH', 0.25e0), ('3-MEDIUM', 0.2e0), ('4-NOT SPECIFIED', 0.05e0), ('5-LOW', 0.15e0)) AS s(p, share)
  ON p = o_orderpriority GROUP BY 1, 2
""")
def literal_shares(spark, sf):
    shares = {"1-URGENT": 0.35, "2-HIGH": 0.25, "3-MEDIUM": 0.2, "4-NOT SPECIFIED": 0.05, "5-LOW": 0.15}
    named = tables.literal_table(spark, shares, "o_orderpriority", "share")
    return table(spark, sf, "orders").join(named, "o_orderpriority").groupBy("o_orderpriority", "share").agg(
        F.count(F.lit(1)).alias("orders")
    )
