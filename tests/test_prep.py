import datetime as dt
import hashlib

from pyspark.sql import functions as F

from placetime.functions import values
from placetime.operators import prep


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_equality_filter_drops_missing_and_counts_them(spark):
    df = spark.createDataFrame([("US", 1), (None, 2), ("CA", 3)], "code string, n int")
    assert rows(prep.only_equal(df, "code", "US")) == [("US", 1)]
    assert prep.dropped_by_missing(df, "code").first()["dropped"] == 1


def test_open_interval_is_strict_at_both_ends(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4)], "n int")
    assert rows(prep.between_open(df, "n", 1, 4)) == [(2,), (3,)]
    assert rows(prep.between_open(df, "n", high=2)) == [(1,)]


def test_time_buckets_in_both_modes(spark):
    days = ["1924-12-31", "1925-01-01", "1934-12-31", "1935-01-01", "2014-06-01", "2025-01-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    closed = [r[0] for r in df.select(values.time_bucket("d", 1925, 2025)).collect()]
    assert closed == ["before", "1925-1935", "1925-1935", "1935-1945", "2005-2015", "after"]
    open_ = [r[0] for r in df.select(values.time_bucket("d", 1925, 2025, bounds="open")).collect()]
    assert open_ == ["before", None, "1925-1935", None, "2005-2015", None]


def test_open_mode_keeps_a_boundary_day_after_midnight(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '1935-01-01 00:00:01' AS t UNION ALL SELECT TIMESTAMP_NTZ '1935-01-01 00:00:00'")
    got = sorted((r[0] or "-") for r in df.select(values.time_bucket("t", 1925, 2025, bounds="open")).collect())
    assert got == ["-", "1935-1945"]


def test_merge_renames_clashes_and_is_many_to_many(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), (None, 3)], "city string, v int")
    b = spark.createDataFrame([("x", 10), ("x", 20), (None, 30)], "city string, v int")
    merged = prep.merge_tables(a, b, ["city"])
    assert merged.columns == ["city", "v_x", "v_y"]
    assert rows(merged) == [("x", 1, 10), ("x", 1, 20), ("x", 2, 10), ("x", 2, 20)]
    assert prep.merge_tables(a, b, ["city"], null_safe=True).where("city IS NULL").collect() == [(None, 3, 30)]


def test_first_per_key_keeps_whole_rows_and_ignores_layout(spark):
    df = spark.createDataFrame([("a", 2, "p"), ("a", 1, "z"), ("a", 1, "q"), ("b", 5, None)], "k string, o int, s string")
    want = [("a", 1, "q"), ("b", 5, None)]
    for parts in (1, 8):
        assert rows(prep.first_per_key(df.repartition(parts), ["k"], ["o"])) == want


def test_points_fail_on_missing_coordinates(spark):
    import pytest

    df = spark.createDataFrame([(1.0, 2.0)], "lon double, lat double")
    made = prep.with_points(df)
    assert made.columns == ["geom", "srid"]
    assert rows(prep.with_coordinates(made).select("lon", "lat", "srid")) == [(1.0, 2.0, 4326)]
    bad = spark.createDataFrame([(None, 2.0)], "lon double, lat double")
    with pytest.raises(Exception, match="missing coordinate"):
        prep.with_points(bad).collect()


def test_valid_coordinates(spark):
    df = spark.createDataFrame(
        [("1", "2"), ("x", "2"), ("NaN", "1"), (None, "1"), ("Infinity", "0"), ("-3.5", "1e2")], "lat string, lng string"
    )
    assert rows(prep.valid_coordinates(df, "lat", "lng")) == [("-3.5", "1e2"), ("1", "2")]


def test_to_day_from_numbers_and_times(one):
    assert one(values.to_day(F.lit(19000), numeric=True)) == dt.date(2022, 1, 8)
    assert one(values.to_day(F.lit("2020-05-06 23:59:59").cast("timestamp"))) == dt.date(2020, 5, 6)


def test_jitter_stays_in_bounds_and_does_not_depend_on_partitions(spark):
    def run(parts):
        df = spark.range(2000).repartition(parts)
        return sorted(r[0] for r in df.select(values.jitter(F.lit(10.0), 0.5, "id", 7)).collect())

    one_, many = run(1), run(8)
    assert one_ == many
    assert min(one_) >= 9.5 and max(one_) <= 10.5
    assert abs(sum(one_) / len(one_) - 10) < 0.05


def test_jitter_is_the_first_52_bits_of_an_md5(spark):
    df = spark.createDataFrame([("1",), ("é",), (None,)], "id string")
    for seed in (1, 2):
        want = [int(hashlib.md5(f"{k}:{seed}".encode()).hexdigest()[:13], 16) / 2**52 * 2 - 1 for k in ("1", "é", "")]
        assert sorted(r[0] for r in df.select(values.jitter(F.lit(0.0), 1.0, "id", seed)).collect()) == sorted(want)


def test_base_groups(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "g string")
    assert rows(prep.show_base_group(df, "g", ["a", "b", "c"], ["b", "c"])) == [("b",), ("d",)]
    assert rows(prep.show_groups(df, "g", ["a", "zz"])) == [("a",)]


def test_extremes_report_missing(spark):
    df = spark.createDataFrame([(3,), (None,), (1,)], "n int")
    assert tuple(prep.extremes(df, "n").first()) == (1, 3, 1)
