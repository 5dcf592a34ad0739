"""Keyed layers, linked selections, array columns and option maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from placetime.functions import text, values
from placetime.operators import arrays, keyed
from placetime.operators.ordered import ordered_columns
from placetime.plans.registry import documents, query, r6, table

_CHANGES_SQL = """
changes AS (
  SELECT event_type AS category, CASE WHEN value < 2 THEN NULL ELSE user_id END AS layer_id, ts, event_id, value FROM events)"""


def _changes(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("category"),
        F.when(F.col("value") >= 2, F.col("user_id")).alias("layer_id"), "ts", "event_id", "value",
    )


_KEYS, _SEQ = ["category", "layer_id"], ["ts", "event_id"]


@query(f"""
WITH {_CHANGES_SQL}, last AS (
  SELECT *, row_number() OVER (PARTITION BY category, layer_id ORDER BY ts DESC, event_id DESC) AS rn FROM changes
)
SELECT category, layer_id, event_id, value FROM last WHERE layer_id IS NULL OR rn = 1
""")
def latest_layers(spark, sf):
    latest = keyed.latest_per_key(_changes(spark, sf), _KEYS, _SEQ, optional="layer_id")
    return latest.select("category", "layer_id", "event_id", "value")


@query(f"""
WITH {_CHANGES_SQL}
SELECT category, layer_id, event_id, lag(event_id) OVER (PARTITION BY category, layer_id ORDER BY ts, event_id) AS old_event_id
FROM changes WHERE layer_id IS NOT NULL
""")
def replaced_layers(spark, sf):
    rows = keyed.replaced_by(_changes(spark, sf), _KEYS, _SEQ, ["event_id"])
    return rows.select("category", "layer_id", "event_id", "old_event_id")


@query("""
SELECT user_id, event_type, value, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def latest_state(spark, sf):
    return keyed.latest_state(table(spark, sf, "events"), "user_id", _SEQ, ["event_type", "value", "event_id"])


_SELECTED_SQL = "selected AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 40)"


def _selected(spark, sf):
    return table(spark, sf, "events").where((F.col("event_type") == "purchase") & (F.col("value") > 40)).select("user_id")


@query(f"WITH {_SELECTED_SQL} SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM selected)")
def linked_filter(spark, sf):
    layers = table(spark, sf, "events").select("event_id", "user_id")
    return keyed.linked_filter(layers, _selected(spark, sf), ["user_id"], ["event_id"])


@query(f"""
WITH {_SELECTED_SQL}
SELECT event_id, CASE WHEN user_id IN (SELECT user_id FROM selected) THEN 0.5e0 ELSE 0.1e0 END AS opacity,
       round(0.2e0 * CASE WHEN user_id IN (SELECT user_id FROM selected) THEN 1e0 ELSE 0.2e0 END, 6) AS fill_opacity FROM events
""")
def linked_highlight(spark, sf):
    layers = table(spark, sf, "events").select("event_id", "user_id")
    shown = keyed.linked_highlight(layers, _selected(spark, sf), ["user_id"], ["event_id"])
    return shown.select("event_id", r6("opacity").alias("opacity"), r6("fill_opacity").alias("fill_opacity"))


@query("""
SELECT event_id, event_type, user_id FROM events e WHERE NOT EXISTS (
  SELECT 1 FROM events d WHERE d.event_type = 'error' AND d.value > 10 AND d.user_id = e.user_id AND e.event_type = 'click')
""")
def deleted_keys(spark, sf):
    layers = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    doomed = table(spark, sf, "events").where((F.col("event_type") == "error") & (F.col("value") > 10)).select(
        F.lit("click").alias("event_type"), "user_id"
    )
    return keyed.delete_keys(layers, doomed, ["event_type", "user_id"], ["event_id"]).select("event_id", "event_type", "user_id")


@query("SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error', 'signup')")
def deleted_groups(spark, sf):
    layers = table(spark, sf, "events").select("event_id", "event_type")
    return keyed.delete_groups(layers, "event_type", ["error", "signup"])


_ZOOM_SQL = """
rules AS (
  SELECT event_type, count(*) FILTER (WHERE value > 5) % 2 = 0 AS always,
         [min(user_id) % 3, max(user_id) % 5, 4] AS zooms FROM events WHERE event_type <> 'view' GROUP BY event_type)"""


@query(f"""
WITH {_ZOOM_SQL}
SELECT e.event_id, e.event_type FROM events e LEFT JOIN rules r USING (event_type)
WHERE r.event_type IS NULL OR r.always OR list_contains(r.zooms, e.user_id % 7)
""")
def visible_groups(spark, sf):
    events = table(spark, sf, "events")
    rules = events.where(F.col("event_type") != "view").groupBy("event_type").agg(
        (F.count_if(F.col("value") > 5) % 2 == 0).alias("always"),
        F.array(F.min("user_id") % 3, F.max("user_id") % 5, F.lit(4).cast("bigint")).alias("zooms"),
    )
    layers = events.select("event_id", "event_type", "user_id")
    return keyed.visible_at(layers, rules, "event_type", F.col("user_id") % 7).select("event_id", "event_type")


_LISTING_SQL = r"""
paths AS (
  SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*/?([^?#]*)', 1) AS path FROM pages
), membership AS (
  SELECT page_id, 'all/index.html' AS listing, 2 AS position FROM paths
  UNION ALL SELECT page_id, 'news/index.html', 1 FROM paths WHERE contains(url, '?')
  UNION ALL SELECT page_id, concat(split_part(path, '/', 1), '/index.html'), 3 FROM paths WHERE starts_with(url, 'https')
  UNION ALL SELECT page_id, concat(split_part(path, '/', 1), '/', split_part(path, '/', 2), '/list.html'), 4 FROM paths
    WHERE NOT contains(url, '#') AND NOT contains(path, '.')
), scored AS (
  SELECT page_id, listing, position, contains(url, 'ref=') AND listing = 'all/index.html' AS referred,
         list_max(list_transform(range(1, len(string_split(path, '/')) + 1),
           lambda k: CASE WHEN string_split(path, '/')[1:k] = string_split(listing, '/')[1:k] THEN k ELSE 0 END)) AS shared
  FROM membership JOIN paths USING (page_id)
)"""


@query(f"""
WITH {_LISTING_SQL}
SELECT page_id, CAST(max(shared) AS BIGINT) AS shared,
       CASE WHEN max(shared) > 0 THEN arg_min(listing, -100 * shared + position)
            ELSE coalesce(arg_min(listing, position) FILTER (WHERE referred), arg_min(listing, position)) END AS listing
FROM scored GROUP BY page_id
""")
def nearest_listings(spark, sf):
    paths = table(spark, sf, "pages").select(
        "page_id", "url", text.path_of("url").alias("path"),
        F.when(F.contains("url", F.lit("ref=")), "all/index.html").alias("referrer"),
    )
    one, two = F.split_part("path", F.lit("/"), F.lit(1)), F.split_part("path", F.lit("/"), F.lit(2))
    deep = ~F.contains("url", F.lit("#")) & ~F.contains("path", F.lit("."))
    listings = F.array_compact(F.array(
        F.struct(F.lit("all/index.html").alias("listing"), F.lit(2).alias("position")),
        F.when(F.contains("url", F.lit("?")), F.struct(F.lit("news/index.html").alias("listing"), F.lit(1).alias("position"))),
        F.when(F.startswith("url", F.lit("https")), F.struct(F.concat(one, F.lit("/index.html")).alias("listing"), F.lit(3).alias("position"))),
        F.when(deep, F.struct(F.concat(one, F.lit("/"), two, F.lit("/list.html")).alias("listing"), F.lit(4).alias("position"))),
    ))
    membership = paths.select("page_id", F.inline(listings))
    return keyed.nearest_listing(paths.select("page_id", "path", "referrer"), membership)


@query("""
SELECT coalesce(CAST(quality AS VARCHAR), 'NA') AS quality, count(*) AS rows
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1
""")
def classes_with_missing(spark, sf):
    both = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return keyed.class_counts(both, "quality")


@query("""
SELECT event_type AS label, concat('c', length(event_type)) AS colour FROM events GROUP BY event_type
UNION ALL SELECT 'NA', '#808080'
""")
def class_domain(spark, sf):
    domain = table(spark, sf, "events").select(F.col("event_type").alias("label")).distinct().withColumn(
        "colour", F.concat(F.lit("c"), F.length("label"))
    )
    return keyed.with_missing_class(domain, "label", "colour", "#808080")


@query("""
SELECT o_orderkey, ['green', 'limegreen', 'darkgreen'][(row_number() OVER (ORDER BY o_orderkey) - 1) % 3 + 1] AS colour FROM orders
""")
def recycled_values(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    ranked = ordered_columns(orders, [], ["o_orderkey"], rank="n")
    colour = values.recycle(["green", "limegreen", "darkgreen"], F.col("n") - 1)
    return ranked.select("o_orderkey", colour.alias("colour"))


@query("""
SELECT o_orderkey, split_part(o_orderpriority, '-', 2) AS priority FROM orders
""")
def decoded_strings(spark, sf):
    orders = table(spark, sf, "orders")
    code = F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int") - 1
    words = ["URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED", "LOW"]
    return orders.select("o_orderkey", values.decode(words, code).alias("priority"))


@query("""
WITH styles AS (
  SELECT event_id, MAP {'color': 'green', 'radius': '1', 'weight': '2'} AS g,
         CASE WHEN event_type = 'click' THEN MAP {'color': 'blue', 'fill': event_type} END AS f,
         CASE WHEN value > 10 THEN MAP {'radius': CAST(user_id AS VARCHAR)} END AS p FROM events)
SELECT event_id, coalesce(p['radius'], f['radius'], g['radius']) AS radius, coalesce(p['color'], f['color'], g['color']) AS color,
       coalesce(p['weight'], f['weight'], g['weight']) AS weight, coalesce(p['fill'], f['fill'], g['fill']) AS fill FROM styles
""")
def merged_options(spark, sf):
    lit = F.lit
    general = F.create_map(lit("color"), lit("green"), lit("radius"), lit("1"), lit("weight"), lit("2"))
    feature = F.when(F.col("event_type") == "click", F.create_map(lit("color"), lit("blue"), lit("fill"), F.col("event_type")))
    own = F.when(F.col("value") > 10, F.create_map(lit("radius"), F.col("user_id").cast("string")))
    merged = table(spark, sf, "events").select("event_id", values.merge_options(general, feature, own).alias("o"))
    return merged.select("event_id", *(F.col("o")[k].alias(k) for k in ("radius", "color", "weight", "fill")))


@query("""
SELECT doc_id, unnest(words) AS word, unnest(list_transform(words, lambda w: length(w))) AS size
FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents)
""")
def zipped_rows(spark, sf):
    docs = documents(spark, sf).select("doc_id", F.split("text", " ").alias("words"))
    return arrays.zipped(docs, ["doc_id"], word="words", size=F.transform("words", F.length))


@query("""
SELECT vec_id, r, c, embedding[c * 8 + r + 1] AS v
FROM embeddings, range(8) AS a(r), range(8) AS b(c)
""")
def transposed_arrays(spark, sf):
    matrix = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, F.lit(8)))
    turned = table(spark, sf, "embeddings").select("vec_id", values.transpose(matrix).alias("m"))
    rows = turned.select("vec_id", F.posexplode("m").alias("r", "row"))
    return rows.select("vec_id", "r", F.posexplode("row").alias("c", "v"))


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS radius, 'limegreen' AS "fillColor",
       CASE WHEN event_type = 'click' THEN event_type END AS popup, user_id > 50 AS stroke
FROM events
""")
def styled_features(spark, sf):
    lit = F.lit
    properties = F.map_filter(F.create_map(
        lit("radius"), F.get_json_object("props", "$.k"), lit("fillColor"), lit("limegreen"),
        lit("popup"), F.when(F.col("event_type") == "click", F.col("event_type")),
        lit("stroke"), (F.col("user_id") > 50).cast("string"),
    ), lambda _k, v: v.isNotNull())
    features = table(spark, sf, "events").select("event_id", properties.alias("properties"))
    return keyed.styled_features(features).select("event_id", "radius", "fillColor", "popup", "stroke")


@query("SELECT event_id, concat(event_type, ':', user_id) AS layer FROM events WHERE value > 5")
def row_callback(spark, sf):
    layer = F.when(F.col("value") > 5, F.concat_ws(":", "event_type", "user_id"))
    return keyed.map_rows(table(spark, sf, "events"), layer, "layer").select("event_id", "layer")
