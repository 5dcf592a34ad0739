from pyspark.sql import functions as F

from placetime.operators import keyed


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def layers(spark):
    return spark.createDataFrame(
        [("m", "a", 1, "x"), ("m", "a", 2, "y"), ("m", None, 3, "p"), ("m", None, 4, "q"), ("s", "a", 5, "z")],
        "category string, id string, seq int, v string",
    )


def test_last_write_wins_and_rows_without_id_append(spark):
    for parts in (1, 8):
        got = keyed.latest_per_key(layers(spark).repartition(parts), ["category", "id"], ["seq"], optional="id")
        assert rows(got) == rows(layers(spark).where("seq > 1"))


def test_replaced_rows(spark):
    got = keyed.replaced_by(layers(spark), ["category", "id"], ["seq"], ["v"])
    assert sorted((r.seq, r.old_v or "-") for r in got.collect()) == [(1, "-"), (2, "x"), (5, "-")]


def test_linked_filter_null_and_empty_selections(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "n int, key string")
    none = spark.createDataFrame([], "key string")
    some = spark.createDataFrame([("a",), ("a",), ("zz",)], "key string")
    assert keyed.linked_filter(df, None, ["key"], ["n"]).count() == 3
    assert keyed.linked_filter(df, none, ["key"], ["n"]).count() == 0
    assert sorted(r.n for r in keyed.linked_filter(df, some, ["key"], ["n"]).collect()) == [1, 2]


def test_linked_highlight(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 0.8)], "n int, key string, stroke double")
    some = spark.createDataFrame([("a",)], "key string")
    none = some.limit(0)

    def opacity(selection):
        shown = keyed.linked_highlight(df, selection, ["key"], ["n"], stroke="stroke")
        return {r.n: (round(r.opacity, 9), round(r.fill_opacity, 9)) for r in shown.collect()}

    assert opacity(some) == {1: (0.5, 0.2), 2: (0.16, 0.04)}
    assert opacity(none) == opacity(None) == {1: (0.5, 0.2), 2: (0.8, 0.2)}


def test_deletes(spark):
    doomed = spark.createDataFrame([("m", "a"), ("m", "unknown")], "category string, id string")
    left = keyed.delete_keys(layers(spark), doomed, ["category", "id"], ["seq"])
    assert sorted(r.seq for r in left.collect()) == [3, 4, 5]
    assert sorted(r.seq for r in keyed.delete_groups(layers(spark), "category", ["m"]).collect()) == [5]
    assert keyed.delete_groups(layers(spark), "category").count() == 0
    groups = spark.createDataFrame([("g",), (None,)], "grp string")
    assert keyed.delete_groups(groups, "grp", ["g"]).collect() == [(None,)]


def test_zoom_visibility(spark):
    df = spark.createDataFrame([("always",), ("list",), ("free",), ("never",)], "g string")
    rules = spark.createDataFrame(
        [("always", True, None), ("list", False, [0, 3]), ("never", None, None)], "g string, always boolean, zooms array<int>"
    )
    shown = lambda z: sorted(r.g for r in keyed.visible_at(df, rules, "g", F.lit(z)).collect())
    assert shown(0) == ["always", "free", "list"] and shown(1) == ["always", "free"]


def test_nearest_listing_rules(spark):
    pages = spark.createDataFrame(
        [(1, "en/25/x", None), (2, "fr/1", "b.html"), (3, "fr/1", "nope.html"), (4, "de/1", None)],
        "page_id int, path string, referrer string",
    )
    member = spark.createDataFrame(
        [(1, "en/index.html", 0), (1, "en/25/list.html", 1), (1, "en/25/more.html", 2),
         (2, "a.html", 0), (2, "b.html", 1), (3, "b.html", 1), (3, "a.html", 0)],
        "page_id int, listing string, position int",
    )
    got = {r.page_id: (r.listing, r.shared) for r in keyed.nearest_listing(pages, member).collect()}
    assert got == {1: ("en/25/list.html", 2), 2: ("b.html", 0), 3: ("a.html", 0)}


def test_classes(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "c string")
    assert rows(keyed.class_counts(df, "c")) == [repr(("NA", 1)), repr(("a", 2))]
    domain = spark.createDataFrame([("a", "red")], "label string, colour string")
    full = keyed.with_missing_class(domain, "label", "colour", "grey")
    assert rows(full) == [repr(("NA", "grey")), repr(("a", "red"))]
    assert rows(keyed.with_missing_class(full, "label", "colour", "black")) == rows(full)


def test_styles_and_row_callback(spark):
    df = spark.createDataFrame([({"radius": "2.5", "fill": "true", "popup": "hi", "weight": "x"},)], "properties map<string,string>")
    r = keyed.styled_features(df).first()
    assert (r.radius, r.fill, r.popup, r.weight, r.label) == (2.5, True, "hi", None, None)
    got = keyed.map_rows(spark.range(4), F.when(F.col("id") % 2 == 0, F.col("id") * 10), "v")
    assert sorted(x.v for x in got.collect()) == [0, 20]


def test_latest_state(spark):
    df = spark.createDataFrame([("m", 1, "old", None), ("m", 2, None, 5)], "id string, t int, a string, b int")
    assert keyed.latest_state(df, "id", ["t"], ["a", "b"]).collect() == [("m", None, 5)]
