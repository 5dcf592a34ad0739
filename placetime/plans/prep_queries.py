"""Event and place preparation, time slices and ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from placetime.functions import values
from placetime.operators import prep
from placetime.operators.joins import fanout_report
from placetime.plans.fixtures import POINTS_SQL, points
from placetime.plans.registry import query, r6, table

_FIRST, _LAST, _WIDTH = 1995, 2003, 2

_SLICE_SQL = f"""
  concat({_FIRST} + ((year(o_orderdate) - {_FIRST}) // {_WIDTH}) * {_WIDTH}, '-',
         {_FIRST} + ((year(o_orderdate) - {_FIRST}) // {_WIDTH}) * {_WIDTH} + {_WIDTH})"""


@query(f"""
SELECT CASE WHEN year(o_orderdate) < {_FIRST} THEN 'before' WHEN year(o_orderdate) >= {_LAST} THEN 'after'
            ELSE {_SLICE_SQL} END AS slice, count(*) AS points
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1
""")
def slice_counts(spark, sf):
    return prep.slice_counts(table(spark, sf, "orders"), "o_orderdate", _FIRST, _LAST, _WIDTH)


@query(f"""
SELECT CASE WHEN year(o_orderdate) < {_FIRST} THEN 'before' WHEN year(o_orderdate) >= {_LAST} THEN 'after'
            ELSE {_SLICE_SQL} END AS slice, count(*) AS points
FROM orders
WHERE NOT (month(o_orderdate) = 1 AND day(o_orderdate) = 1 AND (year(o_orderdate) - {_FIRST}) % {_WIDTH} = 0
           AND o_orderdate = date_trunc('day', o_orderdate) AND year(o_orderdate) >= {_FIRST})
GROUP BY 1
""")
def slice_counts_open(spark, sf):
    return prep.slice_counts(table(spark, sf, "orders"), "o_orderdate", _FIRST, _LAST, _WIDTH, "open")


@query(f"SELECT o_orderkey, {_SLICE_SQL} AS slice FROM orders")
def labelled_slices(spark, sf):
    df = prep.label_slices(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", _FIRST, _LAST, _WIDTH)
    return df.select("o_orderkey", "slice")


@query("""
SELECT slice, count(*) AS points, round(sum(o_totalprice), 2) AS total FROM (
  SELECT 'early' AS slice, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
  UNION ALL
  SELECT 'late', o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'
) GROUP BY slice
""")
def slices_union(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderdate", "o_totalprice")
    day = dt.datetime
    both = prep.labelled_union({
        "early": prep.between_open(orders, "o_orderdate", high=day(1997, 1, 1)),
        "late": prep.between_open(orders, "o_orderdate", day(1999, 1, 1), day(2001, 1, 1)),
    })
    return both.groupBy("slice").agg(
        F.count(F.lit(1)).alias("points"), r6(F.sum("o_totalprice"), digits=2).alias("total")
    )


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders
WHERE o_orderdate > TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
""")
def open_interval(spark, sf):
    inside = prep.between_open(table(spark, sf, "orders"), "o_orderdate", dt.datetime(1995, 1, 1), dt.datetime(1997, 1, 1))
    return inside.select("o_orderkey", values.to_day("o_orderdate").alias("day"), "o_totalprice")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def column_slice(spark, sf):
    return prep.first_columns(table(spark, sf, "orders"), 4)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def equality_filter(spark, sf):
    return prep.only_equal(table(spark, sf, "customer"), "c_mktsegment", "BUILDING").select("c_custkey", "c_name", "c_acctbal")


@query("""
SELECT count(*) FILTER (WHERE l.quality IS NULL) AS dropped
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def dropped_by_missing(spark, sf):
    both = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return prep.dropped_by_missing(both, "quality")


@query("""
SELECT event_id, CAST(ts AS DATE) AS ts, round(value * 2, 6) AS doubled, upper(event_type) AS kind FROM events
""")
def derived_columns(spark, sf):
    df = table(spark, sf, "events").withColumns({
        "ts": values.to_day("ts"), "doubled": r6(F.col("value") * 2), "kind": F.upper("event_type"),
    })
    return df.select("event_id", "ts", "doubled", "kind")


@query("SELECT o_orderkey, CAST(DATE '1970-01-01' + CAST(o_custkey AS INTEGER) AS DATE) AS day FROM orders")
def days_from_origin(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", values.to_day("o_custkey", numeric=True).alias("day"))


@query("SELECT event_id, TRUE AS lat_inside, TRUE AS lon_inside, TRUE AS moved FROM events")
def jitter_bounds(spark, sf):
    df = points(spark, sf).withColumns({
        "jlat": values.jitter("lat", 0.0001, "event_id", 1), "jlon": values.jitter("lon", 0.0002, "event_id", 2),
    })
    slack = 1e-12
    return df.select(
        "event_id",
        (F.abs(F.col("jlat") - F.col("lat")) <= 0.0001 + slack).alias("lat_inside"),
        (F.abs(F.col("jlon") - F.col("lon")) <= 0.0002 + slack).alias("lon_inside"),
        ((F.col("jlat") != F.col("lat")) | (F.col("jlon") != F.col("lon"))).alias("moved"),
    )


@query(f"""
WITH {POINTS_SQL}, noise AS (
  SELECT *, ('0x' || substr(md5(concat(event_id, ':1')), 1, 13))::BIGINT / 4503599627370496e0 AS u,
         ('0x' || substr(md5(concat(event_id, ':2')), 1, 13))::BIGINT / 4503599627370496e0 AS v FROM points
)
SELECT event_id, round(lat + (u * 2 - 1) * 0.0001e0, 9) AS jittered_lat, round(lon + (v * 2 - 1) * 0.0002e0, 9) AS jittered_lon FROM noise
""")
def jittered_points(spark, sf):
    return points(spark, sf).select(
        "event_id", r6(values.jitter("lat", 0.0001, "event_id", 1), digits=9).alias("jittered_lat"),
        r6(values.jitter("lon", 0.0002, "event_id", 2), digits=9).alias("jittered_lon"),
    )


@query(f"WITH {POINTS_SQL} SELECT event_id, lon, lat, 4326 AS srid FROM points")
def point_columns(spark, sf):
    made = prep.with_points(points(spark, sf))
    return prep.with_coordinates(made).select("event_id", "lon", "lat", "srid")


@query("""
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE d.lang IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL
""")
def complete_rows(spark, sf):
    both = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return prep.complete_rows(both).select("doc_id", "lang", "quality", "toxic")


@query(f"""
WITH {POINTS_SQL}, texts AS (
  SELECT event_id,
         CASE event_type WHEN 'error' THEN 'n/a' WHEN 'view' THEN 'NaN' ELSE CAST(lat AS VARCHAR) END AS lat,
         CASE WHEN value > 20 THEN NULL WHEN value < 1 THEN 'Infinity' ELSE CAST(lon AS VARCHAR) END AS lng
  FROM points
)
SELECT event_id, lat, lng FROM texts
WHERE isfinite(TRY_CAST(lat AS DOUBLE)) AND isfinite(TRY_CAST(lng AS DOUBLE))
""")
def valid_coordinates(spark, sf):
    texts = points(spark, sf).select(
        "event_id",
        F.when(F.col("event_type") == "error", "n/a").when(F.col("event_type") == "view", "NaN")
        .otherwise(F.col("lat").cast("string")).alias("lat"),
        F.when(F.col("value") > 20, None).when(F.col("value") < 1, "Infinity")
        .otherwise(F.col("lon").cast("string")).alias("lng"),
    )
    return prep.valid_coordinates(texts, "lat", "lng")


def _order_sides(spark, sf):
    left = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("place"), "o_orderkey", F.round("o_totalprice", 2).alias("amount")
    )
    right = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("place"), "c_mktsegment", F.round("c_acctbal", 2).alias("amount")
    )
    return left, prep.only_equal(right, "c_mktsegment", "BUILDING")


@query("""
SELECT o_custkey AS place, o_orderkey, round(o_totalprice, 2) AS amount_x, c_mktsegment, round(c_acctbal, 2) AS amount_y
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'
""")
def merged_tables(spark, sf):
    left, right = _order_sides(spark, sf)
    return prep.merge_tables(left, right, ["place"])


@query("""
WITH a AS (SELECT CASE WHEN user_id % 10 > 0 THEN user_id END AS place, event_id FROM events WHERE event_type = 'purchase'),
b AS (SELECT CASE WHEN n_nationkey % 10 > 0 THEN n_nationkey END AS place, n_name FROM nation)
SELECT a.place, event_id, n_name FROM a JOIN b ON a.place IS NOT DISTINCT FROM b.place
""")
def merged_null_safe(spark, sf):
    """Rows without a place meet the places without a key."""
    events = prep.only_equal(table(spark, sf, "events"), "event_type", "purchase")
    left = events.select(F.when(F.col("user_id") % 10 > 0, F.col("user_id")).alias("place"), "event_id")
    right = table(spark, sf, "nation").select(F.when(F.col("n_nationkey") % 10 > 0, F.col("n_nationkey")).alias("place"), "n_name")
    return prep.merge_tables(left, right, ["place"], null_safe=True)


@query("""
SELECT c_nationkey AS place, c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey ORDER BY c_nationkey
""")
def sorted_merge(spark, sf):
    left = table(spark, sf, "customer").select(F.col("c_nationkey").alias("place"), "c_custkey")
    right = table(spark, sf, "nation").select(F.col("n_nationkey").alias("place"), "n_name")
    return prep.sorted_merge(left, right, ["place"])


@query("""
WITH a AS (SELECT s_nationkey AS k, count(*) AS l FROM supplier GROUP BY 1),
     b AS (SELECT c_nationkey AS k, count(*) AS r FROM customer GROUP BY 1)
SELECT count(*) AS keys, CAST(sum(l) AS BIGINT) AS left_rows, CAST(sum(r) AS BIGINT) AS right_rows,
       CAST(sum(l * r) AS BIGINT) AS joined_rows, round(sum(l * r) / sum(l), 6) AS growth
FROM a JOIN b USING (k)
""")
def merge_fanout(spark, sf):
    left = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    right = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"))
    return fanout_report(left, right, ["k"]).withColumn("growth", r6("growth"))


@query("""
SELECT c_custkey, n_name, r_name FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def region_lookup(spark, sf):
    dimension = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return prep.lookup(customers, dimension, ["c_nationkey"]).select("c_custkey", "n_name", "r_name")


@query("SELECT min(ts) AS lowest, max(ts) AS highest, count(*) FILTER (WHERE ts IS NULL) AS missing FROM events")
def extremes(spark, sf):
    return prep.extremes(table(spark, sf, "events"), "ts")


@query("""
SELECT day, o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM (
  SELECT CAST(o_orderdate AS DATE) AS day, *, row_number() OVER (
    PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_custkey, o_orderkey, o_totalprice, o_orderpriority) AS rn
  FROM orders) WHERE rn = 1
""")
def first_per_day(spark, sf):
    df = table(spark, sf, "orders").select(
        values.to_day("o_orderdate").alias("day"), "o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority"
    )
    return prep.first_per_key(df, ["day"], ["o_custkey"])


@query("SELECT event_type, count(*) AS points FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1")
def shown_groups(spark, sf):
    return prep.show_groups(table(spark, sf, "events"), "event_type", ["click", "purchase"]).groupBy(
        "event_type").agg(F.count(F.lit(1)).alias("points"))


@query("SELECT event_type, count(*) AS points FROM events WHERE event_type NOT IN ('view', 'error') GROUP BY 1")
def shown_base_group(spark, sf):
    df = prep.show_base_group(table(spark, sf, "events"), "event_type", ["view", "click", "error"], ["click", "error"])
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("points"))


@query("""
SELECT event_id, ts, user_id FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' ORDER BY ts, event_id
""")
def slider_range(spark, sf):
    df = table(spark, sf, "events").select("event_id", "ts", "user_id")
    low, high = (F.lit(v).cast(df.schema["ts"].dataType) for v in ("2024-01-05", "2024-01-20"))
    return prep.time_range(df, "ts", low, high, ["event_id"])


@query("""
SELECT CAST(date_trunc('day', ts) AS DATE) AS step, count(*) AS points FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY 1
""")
def slider_steps(spark, sf):
    df = table(spark, sf, "events")
    low, high = (F.lit(v).cast(df.schema["ts"].dataType) for v in ("2024-01-05", "2024-01-20"))
    return prep.time_steps(df, "ts", low, high, "day")


@query("""
SELECT day, place, o_orderkey, o_totalprice, lon, lat, 4326 AS srid FROM (
  SELECT *, row_number() OVER (PARTITION BY day ORDER BY place, lat, lon, o_orderkey, o_totalprice) AS rn FROM (
    SELECT CAST(o_orderdate AS DATE) AS day, o_custkey AS place, o_orderkey, o_totalprice,
           -125e0 + (c_custkey * 977 % 58000) / 1000e0 AS lon, 24.5e0 + (c_custkey * 7919 % 25000) / 1000e0 AS lat
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'F' AND c_mktsegment = 'BUILDING')
) WHERE rn = 1
""")
def prepared_points(spark, sf):
    sightings = prep.only_equal(table(spark, sf, "orders"), "o_orderstatus", "F").select(
        F.col("o_custkey").alias("place"), "o_orderkey", "o_totalprice", "o_orderdate"
    )
    key = F.col("c_custkey")
    places = prep.only_equal(table(spark, sf, "customer"), "c_mktsegment", "BUILDING").select(
        key.alias("place"),
        (F.lit(-125.0) + key * 977 % 58000 / 1000.0).alias("lon"),
        (F.lit(24.5) + key * 7919 % 25000 / 1000.0).alias("lat"),
    )
    joined = prep.merge_tables(sightings, places, ["place"]).withColumn("day", values.to_day("o_orderdate")).drop("o_orderdate")
    unique = prep.first_per_key(joined, ["day"], ["place", "lat", "lon", "o_orderkey"])
    return prep.with_coordinates(prep.with_points(unique)).drop("geom")
