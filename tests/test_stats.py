import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from placetime.operators import stats
from placetime.operators.ordered import exact_quantiles, ordered_columns, range_bounds, range_number
from placetime.session import checkpointed

# four regression series, F. J. Anscombe (1973)
X = [10, 8, 13, 9, 11, 14, 6, 4, 12, 7, 5]
X4 = [8, 8, 8, 8, 8, 8, 8, 19, 8, 8, 8]
Y = [
    [8.04, 6.95, 7.58, 8.81, 8.33, 9.96, 7.24, 4.26, 10.84, 4.82, 5.68],
    [9.14, 8.14, 8.74, 8.77, 9.26, 8.10, 6.13, 3.10, 9.13, 7.26, 4.74],
    [7.46, 6.77, 12.74, 7.11, 7.81, 8.84, 6.08, 5.39, 8.15, 6.42, 5.73],
    [6.58, 5.76, 7.71, 8.84, 8.47, 7.04, 5.25, 12.50, 5.56, 7.91, 6.89],
]
SERIES = {f"lm{i}": (f"x{i}", f"y{i}") for i in range(1, 5)}
# slope, intercept, R2, SSR, SSE, F, SE slope, SE intercept
KNOWN = {
    "lm1": (0.500091, 3.000091, 0.666542, 27.510001, 13.762690, 17.989943, 0.117906, 1.124747),
    "lm2": (0.500000, 3.000909, 0.666242, 27.500000, 13.776291, 17.965648, 0.117964, 1.125302),
    "lm3": (0.499727, 3.002455, 0.666324, 27.470008, 13.756192, 17.972276, 0.117878, 1.124481),
    "lm4": (0.499909, 3.001727, 0.666707, 27.490001, 13.742490, 18.003288, 0.117819, 1.123921),
}


@pytest.fixture(scope="module")
def quartet(spark):
    rows = [tuple(float(v) for v in (X[i], X[i], X[i], X4[i], *(y[i] for y in Y))) for i in range(11)]
    return spark.createDataFrame(rows, ", ".join([f"x{i} double" for i in range(1, 5)] + [f"y{i} double" for i in range(1, 5)]))


def test_fit_and_tables_give_known_answers(quartet):
    fitted = stats.fit(quartet, SERIES)
    anova = {(r.series, r.term): r for r in stats.anova(fitted).collect()}
    table = {(r.series, r.term): r for r in stats.coefficient_table(fitted).collect()}
    for row in fitted.collect():
        slope, intercept, r2, ssr, sse, f, se_slope, se_intercept = KNOWN[row.series]
        assert row.n == 11
        assert np.allclose([row.slope, row.intercept, row.r2], [slope, intercept, r2], atol=2e-6)
        assert np.allclose([anova[row.series, "x"].sum_sq, anova[row.series, "Residuals"].sum_sq], [ssr, sse], atol=2e-6)
        assert anova[row.series, "x"].f_value == pytest.approx(f, abs=2e-5)
        assert table[row.series, "slope"].std_error == pytest.approx(se_slope, abs=2e-6)
        assert table[row.series, "intercept"].std_error == pytest.approx(se_intercept, abs=2e-6)
    # published p values of the first model
    assert table["lm1", "slope"].p_value == pytest.approx(0.00217, abs=5e-6)
    assert table["lm1", "intercept"].p_value == pytest.approx(0.0257, abs=5e-5)
    assert anova["lm1", "x"].p_value == pytest.approx(0.00217, abs=5e-6)
    assert anova["lm1", "Residuals"].p_value is None


def test_p_values_agree_with_mllib(quartet):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    mine = {(r.series, r.term): r.p_value for r in stats.coefficient_table(stats.fit(quartet, SERIES)).collect()}
    ready = VectorAssembler(inputCols=["x3"], outputCol="f").transform(quartet)
    model = LinearRegression(featuresCol="f", labelCol="y3", solver="normal").fit(ready)
    assert model.summary.pValues == pytest.approx([mine["lm3", "slope"], mine["lm3", "intercept"]], rel=1e-8)


def test_f_tail_special_cases():
    # with 1 and 2 degrees of freedom the tail is 1 - sqrt(f / (f + 2))
    for f in (0.0, 0.3, 1.0, 7.5, 1e4):
        assert stats._f_tail(f, 1, 2) == pytest.approx(1 - math.sqrt(f / (f + 2)), abs=1e-12)
    # with 2 and d degrees of freedom it is (1 + 2 f / d) ** (-d / 2)
    assert stats._f_tail(3.0, 2, 7) == pytest.approx((1 + 6 / 7) ** -3.5, rel=1e-12)
    assert stats._f_tail(2.0, 5, 1e6) == pytest.approx(0.07522, abs=2e-5)


def test_degenerate_series_give_null(spark):
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "x double, y double")
    row = stats.coefficient_table(stats.fit(flat, {"s": ("x", "y")})).where("term = 'slope'").first()
    assert row.estimate is None and row.p_value is None
    two = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0)], "x double, y double")
    row = stats.coefficient_table(stats.fit(two, {"s": ("x", "y")})).where("term = 'slope'").first()
    assert row.estimate == pytest.approx(1.0) and row.p_value is None


def test_summary_matrix_and_residuals(quartet):
    fitted = stats.fit(quartet, SERIES)
    matrix = {r.term: r for r in stats.coefficient_matrix(fitted, list(SERIES)).collect()}
    assert matrix["slope"].lm3 == pytest.approx(KNOWN["lm3"][0], abs=2e-6)
    summary = {r.series: r for r in stats.model_summary(quartet, SERIES).collect()}
    one = summary["lm1"]
    # quartiles as published for the first model
    assert np.allclose([one.res_min, one.res_q1, one.res_median, one.res_q3, one.res_max],
                       [-1.92127, -0.45577, -0.04136, 0.70941, 1.83882], atol=1e-5)
    assert one.res_std_error == pytest.approx(1.237, abs=5e-4)
    assert one.adj_r2 == pytest.approx(0.6295, abs=5e-5)
    assert one.p_value == pytest.approx(0.00217, abs=5e-6)
    left = stats.residuals(quartet, SERIES, fitted).groupBy("series").agg(F.sum("residual").alias("s")).collect()
    assert all(abs(r.s) < 1e-9 for r in left)


def test_shares_and_ramp(spark):
    shares = {"oak": 0.25, "ash": 0.3, "elm": 0.05, "fir": 0.2, "yew": 0.08, "lime": 0.12}
    df = spark.createDataFrame(list(shares.items()), "category string, v double")
    parts = stats.shares(df, "category", "v").orderBy("category").collect()
    assert sum(p.share for p in parts) == pytest.approx(1.0)
    assert parts[0].angle_start == pytest.approx(0.0) and parts[-1].angle_end == pytest.approx(360.0)
    for before, after in zip(parts, parts[1:]):
        assert before.angle_end == pytest.approx(after.angle_start)
    ramp = stats.even_ramp(df, ["category"], 0.3, 1.0, "grey")
    assert sorted(round(r.grey, 9) for r in ramp.collect()) == [0.3, 0.44, 0.58, 0.72, 0.86, 1.0]


def test_profile(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "v double")
    row = stats.column_profile(df, ["v"]).first()
    assert (row.lowest, row.q1, row.median, row.q3, row.highest, row.missing) == (1.0, 1.5, 2.0, 3.0, 4.0, 1)


@pytest.mark.parametrize("size,accuracy", [(1, 10_000), (2, 10_000), (999, 10_000), (5000, 100), (20_000, 200)])
def test_exact_quantiles_with_and_without_the_sketch(spark, size, accuracy):
    rng = np.random.default_rng(size)
    # a third of the values are one number
    values = np.where(rng.random(size) < 0.33, 5.0, rng.lognormal(size=size) * 10)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.probability: r.quantile for r in exact_quantiles(df, ["v"], probabilities, accuracy).collect()}
    for p in probabilities:
        assert got[p] == pytest.approx(float(np.quantile(values, p)), rel=1e-12), p


@pytest.mark.parametrize("ranges", [1, 2, 30, 5000])
def test_ordered_columns_match_a_plain_window(spark, ranges):
    from pyspark.sql import Window as W

    # one key holds most rows
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 7, F.lit(None).cast("int")).otherwise((F.col("id") % 3).cast("int")).alias("k"),
        (F.col("id") * 7919 % 3001).alias("t"), (F.col("id") % 13).cast("double").alias("v"),
    )
    got = ordered_columns(df, ["k"], ["t"], rank="n", running={"s": "v"}, previous={"p": "v"}, following={"f": "t"}, ranges=ranges)
    w = W.partitionBy("k").orderBy("t")
    want = df.select(
        "k", "t", "v", F.row_number().over(w).alias("n"), F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("s"),
        F.lag("v").over(w).alias("p"), F.lead("t").over(w).alias("f"),
    )
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("t", [0.5, 1.0, 2.0, 3.0, 5.0])
@pytest.mark.parametrize("n", [1e9, 1e10, 1e12])
def test_tail_probability_of_many_rows(t, n):
    correction = 1 + (t * t + 1) * t * math.exp(-t * t / 2) / math.sqrt(2 * math.pi) / 2 / n / math.erfc(t / math.sqrt(2))
    assert stats._f_tail(t * t, 1, n) == pytest.approx(math.erfc(t / math.sqrt(2)) * correction, rel=1e-9)


def test_tail_probability_joins_at_the_switch():
    for t in (0.5, 1.0, 2.0, 4.0):
        below, above = stats._f_tail(t * t, 1, 1.99999e5), stats._f_tail(t * t, 1, 2.00001e5)
        assert below == pytest.approx(above, rel=1e-8)


def test_ordered_columns_without_a_key(spark):
    df = spark.range(2000).select(F.col("id").alias("t"), F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("v")).repartition(7)
    got = ordered_columns(df, [], ["t"], rank="n", running={"s": "v"}, previous={"p": "v"}, following={"f": "v"}, ranges=16).collect()
    rows, total, last = sorted(got, key=lambda r: r.t), None, None
    for i, r in enumerate(rows):
        total = r.v if total is None else total + (r.v or 0)
        assert (r.n, r.s, r.p) == (i + 1, total, last)
        assert r.f == (rows[i + 1].v if i + 1 < len(rows) else None)
        last = r.v


def test_ranges_are_about_equal(spark):
    # one key holds most rows, and its order is far from even
    df = spark.range(20_000).select(F.when(F.col("id") < 14_000, "hot").otherwise(F.col("id").cast("string")).alias("k"), (F.col("id") * F.col("id")).alias("t"))
    bounds = range_bounds(df, ["k", "t"], 16).first()["bounds"]
    held = df.withColumn("b", range_bounds(df, ["k", "t"], 16).scalar())
    cut = held.select(range_number(F.col("b"), F.struct("k", "t"), 16).alias("r")).groupBy("r").count().collect()
    assert len(bounds) == 15 and len(cut) == 16 and max(r["count"] for r in cut) < 2.2 * 20_000 / 16
    assert range_bounds(df.where("false"), ["k", "t"], 16).first()["bounds"] in (None, [])


@pytest.mark.parametrize("name,most", [("model_summary", 3), ("column_profile", 2), ("shares_of_total", 2)])
def test_tables_are_scanned_a_fixed_number_of_times(spark, sf, monkeypatch, name, most):
    """Scans of all jobs together; shares read two tables once each."""
    from placetime.operators import ordered
    from placetime.plans.catalog import QUERIES

    plans = []

    def recorded(df):
        plans.append(df)
        return checkpointed(df)

    monkeypatch.setattr(ordered, "checkpointed", recorded)
    monkeypatch.setattr(stats, "checkpointed", recorded)
    plans.append(QUERIES[name](spark, sf))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    texts = [df._jdf.queryExecution().explainString(mode) for df in plans]
    assert sum(len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) for text in texts) <= most
