import json

import pytest
from pyspark.sql import functions as F

from placetime.functions import shapes
from placetime.operators import prep
from placetime.session import checkpointed, fresh_path
from placetime.sources import geojson, layers, tables


def test_csv_with_missing_values(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([("Ohio", "NA"), ("Iowa", "West")], "State string, Region string").coalesce(1).write.option("header", True).csv(path)
    got = tables.read_csv(spark, path, "State string, Region string")
    assert sorted(map(tuple, got.collect()), key=repr) == [("Iowa", "West"), ("Ohio", None)]
    assert tables.read_csv(spark, path, "Region string").columns == ["Region"]


def test_releases_by_date_and_week(spark):
    root = fresh_path(spark, "releases")
    tables.write_release({"sightings": spark.range(3), "places": spark.range(2)}, root, "2024-03-14")
    manifest = tables.manifest_rows(spark, "2024-03-14", ["sightings", "places"])
    by_week = tables.load_release(spark, root, manifest, year=2024, week=11)
    by_date = tables.load_release(spark, root, manifest, date="2024-03-14")
    assert {k: v.count() for k, v in by_week.items()} == {k: v.count() for k, v in by_date.items()} == {"sightings": 3, "places": 2}
    with pytest.raises(LookupError):
        tables.load_release(spark, root, manifest, year=2024, week=12)
    with pytest.raises(LookupError):
        tables.pick_table(by_week, "nope")


def test_json_documents_as_lines_and_as_one_array(spark):
    docs = [{"objectID": "a", "href": "a.html#x", "title": "T", "section": "", "text": "one\ntwo"}, {"href": "b.html", "title": "U"}]
    lines, array = fresh_path(spark, "lines"), fresh_path(spark, "array")
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").write.text(lines)
    spark.createDataFrame([(json.dumps(docs, indent=1),)], "value string").write.text(array)
    a, b = tables.read_documents(spark, lines), tables.read_documents(spark, array, array_file=True)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert b.where("href = 'a.html#x'").first()["text"] == "one\ntwo"


def test_layer_is_replaced_and_binary_is_well_known(spark):
    root = fresh_path(spark, "layers")
    df = spark.createDataFrame([(1, 2.5, -3.25), (2, 1e-9, 90.0)], "id int, lon double, lat double")
    made = prep.with_points(df)
    layers.write_layer(made.where("id = 1"), root, "l")
    layers.write_layer(made, root, "l")
    raw = spark.read.parquet(f"{root}/l/versions/{layers.current_version(spark, root, 'l')[1]}").where("id = 1").select(F.hex("geom").alias("h"), "srid").first()
    assert raw.h == "0101000000" + "0000000000000440" + "0000000000000AC0" and raw.srid == 4326
    back = sorted((r.id, r.geom.lon, r.geom.lat) for r in layers.read_layer(spark, root, "l").collect())
    assert back == [(1, 2.5, -3.25), (2, 1e-9, 90.0)]


def test_a_failed_write_leaves_the_old_layer(spark):
    root = fresh_path(spark, "layers")
    with pytest.raises(LookupError):
        layers.read_layer(spark, root, "l")
    made = prep.with_points(spark.createDataFrame([(1, 2.5, -3.25), (2, 0.0, 90.0)], "id int, lon double, lat double").repartition(2))
    layers.write_layer(made, root, "l")
    reader = layers.read_layer(spark, root, "l")
    broken = made.withColumn("id", F.when(F.col("id") == 1, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("int")))
    with pytest.raises(Exception, match="lost"):
        layers.write_layer(broken, root, "l")
    assert sorted(r.id for r in layers.read_layer(spark, root, "l").collect()) == [1, 2]
    layers.write_layer(made.where("id = 2"), root, "l")
    assert [r.id for r in layers.read_layer(spark, root, "l").collect()] == [2]
    assert sorted(r.id for r in reader.collect()) == [1, 2]  # a reader that had started


def feature(kind, coordinates, **properties):
    return {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}}


def read(spark, *docs, **options):
    df = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "n int, doc string")
    return geojson.read_features(df, "doc", keep=["n"], **options)


def test_features_are_flattened(spark):
    inner = {"type": "FeatureCollection", "features": [feature("Point", [3, 4], a="x")]}
    collection = {"type": "FeatureCollection", "features": [
        feature("Point", [1, 2]), inner, {"type": "Feature", "properties": {}, "geometry": None},
        {"type": "Feature", "properties": {"c": "1"}, "geometry": {"type": "GeometryCollection", "geometries": [
            {"type": "Point", "coordinates": [5, 6]}, {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}]}},
    ]}
    bare = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    got = sorted((r.n, r.geometry_type, json.loads(r.coordinates), dict(r.properties)) for r in read(spark, collection, bare, "{oops").collect())
    assert got == [
        (0, "LineString", [[0, 0], [1, 1]], {"c": "1"}), (0, "Point", [1, 2], {}), (0, "Point", [3, 4], {"a": "x"}),
        (0, "Point", [5, 6], {"c": "1"}), (1, "Polygon", bare["coordinates"], {}),
    ]
    polygon = read(spark, bare).select(geojson.coordinates("Polygon").alias("c")).first()["c"]
    assert polygon == [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]


def test_bad_texts_unknown_types_and_deep_nesting(spark):
    df = spark.createDataFrame([(1, "{oops"), (2, json.dumps(feature("Point", [1, 2]))), (3, None)], "n int, doc string")
    assert sorted(r.n for r in geojson.bad_documents(df, "doc").collect()) == [1, 3]
    with pytest.raises(Exception, match="invalid GeoJSON type Blob"):
        read(spark, feature("Blob", [1, 2])).collect()
    deep = feature("Point", [1, 2])
    many = {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [5, 6]}]}
    for _ in range(5):
        deep = {"type": "FeatureCollection", "features": [deep, feature("Point", [7, 8])]}
        many = {"type": "GeometryCollection", "geometries": [many, {"type": "Point", "coordinates": [9, 9]}]}
    assert read(spark, deep).count() == 6
    got = read(spark, deep, {"type": "Feature", "properties": {"a": "b"}, "geometry": many}, {"type": "FeatureCollection", "features": []})
    assert sorted((r.n, r.coordinates, r.properties.get("a")) for r in got.collect()) == sorted(
        [(0, "[1,2]", None)] + [(0, "[7,8]", None)] * 5 + [(1, "[5,6]", "b")] + [(1, "[9,9]", "b")] * 5, key=str)


def test_hooks(spark):
    docs = [feature("Point", [1, 2], k="a"), feature("Point", [3, 4], k="b")]
    got = read(spark, *docs, only=F.col("properties")["k"] == "b", each={"k": F.col("properties")["k"]})
    assert [(r.n, r.k) for r in got.collect()] == [(1, "b")]


def test_feature_writer_rounds_half_up_and_closes_rings(spark):
    halves = spark.range(1).select(*(geojson.round_half_up(F.lit(v), 0) for v in (-2.5, 2.5, -2.6))).first()
    assert tuple(halves) == (-2.0, 3.0, -3.0)
    at = spark.range(1).select(geojson.position(F.lit(-1.00000049), F.lit(2.12345678), F.lit(7.0)).alias("p")).first()["p"]
    assert at == [-1.0, 2.123457, 7.0]
    ring = F.array(*(shapes.vertex(F.lit(float(x)), F.lit(float(y))) for x, y in ((0, 0), (1, 0), (1, 1))))
    text = spark.range(1).select(geojson.feature("Polygon", F.array(geojson.ring_positions(ring)), F.create_map(F.lit("a"), F.lit("b"))).alias("t"))
    assert json.loads(text.first()["t"]) == {
        "type": "Feature", "properties": {"a": "b"},
        "geometry": {"type": "Polygon", "coordinates": [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]},
    }
    path = fresh_path(spark, "features")
    geojson.write_features(text, "t", path)
    assert geojson.read_features(spark.read.text(path), "value").count() == 1


def test_checkpointed(spark):
    assert sorted(r.id for r in checkpointed(spark.range(3)).collect()) == [0, 1, 2]


def test_literal_table(spark):
    assert tables.literal_table(spark, {"a": 0.5}, "c", "v").collect() == [("a", 0.5)]
