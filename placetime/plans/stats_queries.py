"""Regression tables, profiles, shares and ramps."""

from __future__ import annotations

from pyspark.sql import functions as F

from placetime.operators import stats
from placetime.plans.registry import query, r6, table

SERIES = {
    "s1": ("l_quantity", "l_extendedprice"),
    "s2": ("l_discount", "l_extendedprice"),
    "s3": ("l_tax", "l_extendedprice"),
    "s4": ("l_quantity", "l_discount"),
}

_SUMS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS series, regr_count({y}, {x}) AS n, regr_avgx({y}, {x}) AS mx, regr_avgy({y}, {x}) AS my, "
    f"regr_sxx({y}, {x}) AS sxx, regr_syy({y}, {x}) AS syy, regr_sxy({y}, {x}) AS sxy FROM lineitem"
    for name, (x, y) in SERIES.items()
)
FIT_SQL = f"""
sums AS ({_SUMS}), line AS (
  SELECT *, sxy / sxx AS slope, my - sxy / sxx * mx AS intercept, sxy * sxy / sxx AS ssr, syy - sxy * sxy / sxx AS sse FROM sums
), fit AS (SELECT *, sse / (n - 2) AS mse, ssr / syy AS r2 FROM line)"""

_LONG = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS series, {x} AS x, {y} AS y FROM lineitem" for name, (x, y) in SERIES.items()
)


def _fitted(spark, sf):
    return stats.fit(table(spark, sf, "lineitem"), SERIES)


@query(f"""
WITH {FIT_SQL} SELECT series, CAST(n AS BIGINT) AS n, round(slope, 9) AS slope, round(intercept, 5) AS intercept FROM fit
""")
def regression_lines(spark, sf):
    return _fitted(spark, sf).select("series", "n", r6("slope", digits=9).alias("slope"), r6("intercept", digits=5).alias("intercept"))


@query("""
SELECT l_returnflag, l_linestatus, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n,
       round(regr_slope(l_extendedprice, l_quantity), 5) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 5) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 9) AS r2
FROM lineitem GROUP BY 1, 2
""")
def regression_by_group(spark, sf):
    df = stats.fit_by(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "l_extendedprice")
    return df.withColumns({"slope": r6("slope", digits=5), "intercept": r6("intercept", digits=5), "r2": r6("r2", digits=9)})


@query(f"""
WITH {FIT_SQL}
SELECT series, 'x' AS term, CAST(1 AS BIGINT) AS df, round(ssr / 1e6, 6) AS sum_sq, round(ssr / 1e6, 6) AS mean_sq,
       round(ssr / mse, 5) AS f_value FROM fit
UNION ALL
SELECT series, 'Residuals', CAST(n - 2 AS BIGINT), round(sse / 1e9, 5), round(mse / 1e6, 6), NULL FROM fit
""")
def anova_table(spark, sf):
    table_ = stats.anova(_fitted(spark, sf), with_p=False)
    is_term = F.col("term") == "x"
    return table_.select(
        "series", "term", "df",
        F.when(is_term, r6("sum_sq", 1e6)).otherwise(r6("sum_sq", 1e9, 5)).alias("sum_sq"),
        r6("mean_sq", 1e6).alias("mean_sq"), r6("f_value", digits=5).alias("f_value"),
    )


@query(f"""
WITH {FIT_SQL}, long AS (
  SELECT series, 'intercept' AS term, intercept AS v FROM fit UNION ALL SELECT series, 'slope', slope FROM fit)
SELECT term, {", ".join(f"round(max(v) FILTER (WHERE series = '{s}'), 7) AS {s}" for s in SERIES)} FROM long GROUP BY term
""")
def coefficient_matrix(spark, sf):
    wide = stats.coefficient_matrix(_fitted(spark, sf), list(SERIES))
    return wide.select("term", *(r6(s, digits=7).alias(s) for s in SERIES))


@query(f"""
WITH {FIT_SQL}, t AS (
  SELECT series, 'intercept' AS term, intercept AS estimate, sqrt(mse * (1e0 / n + mx * mx / sxx)) AS std_error FROM fit
  UNION ALL SELECT series, 'slope', slope, sqrt(mse / sxx) FROM fit)
SELECT series, term, round(estimate, 7) AS estimate, round(std_error, 6) AS std_error, round(estimate / std_error, 6) AS t_value FROM t
""")
def coefficient_table(spark, sf):
    return stats.coefficient_table(_fitted(spark, sf), with_p=False).select(
        "series", "term", r6("estimate", digits=7).alias("estimate"), r6("std_error").alias("std_error"), r6("t_value").alias("t_value")
    )


def _p_sql(t: str) -> str:
    """Two-sided tail of the t distribution by Simpson's rule over its density."""
    return f"""(
      SELECT 1 - 2 * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * exp(lgamma((v + 1) / 2) - lgamma(v / 2) - ln(v * pi()) / 2 - (v + 1) / 2 * ln(1 + pow(i * h, 2) / v))) * max(h) / 3
      FROM (SELECT i, least(abs({t}), 40) / 4000 AS h, CAST(n - 2 AS DOUBLE) AS v FROM range(4001) AS s(i)))"""


@query(f"""
WITH {FIT_SQL}, t AS (
  SELECT series, n, 'intercept' AS term, intercept / sqrt(mse * (1e0 / n + mx * mx / sxx)) AS t FROM fit
  UNION ALL SELECT series, n, 'slope', slope / sqrt(mse / sxx) FROM fit)
SELECT series, term, abs(round({_p_sql("t")}, 6)) AS p_value FROM t
""")
def coefficient_p_values(spark, sf):
    return stats.coefficient_table(_fitted(spark, sf)).select("series", "term", r6("p_value").alias("p_value"))


@query(f"""
WITH {FIT_SQL}
SELECT series, 'x' AS term, abs(round({_p_sql("sqrt(ssr / mse)")}, 6)) AS p_value FROM fit
UNION ALL SELECT series, 'Residuals', NULL FROM fit
""")
def anova_p_values(spark, sf):
    return stats.anova(_fitted(spark, sf)).select("series", "term", r6("p_value").alias("p_value"))


@query(f"""
WITH {FIT_SQL}, long AS ({_LONG}), res AS (
  SELECT series, y - (intercept + slope * x) AS e FROM long JOIN fit USING (series)
), q AS (
  SELECT series, min(e) AS q0, quantile_cont(e, 0.25) AS q1, quantile_cont(e, 0.5) AS q2, quantile_cont(e, 0.75) AS q3,
         max(e) AS q4 FROM res GROUP BY series)
SELECT series, round(q0, 5) AS res_min, round(q1, 5) AS res_q1, round(q2, 5) AS res_median, round(q3, 5) AS res_q3,
       round(q4, 5) AS res_max, round(sqrt(mse), 5) AS res_std_error, round(r2, 9) AS r2,
       round(1 - (1 - r2) * (n - 1) / (n - 2), 9) AS adj_r2, round(ssr / mse, 5) AS f_value, CAST(n - 2 AS BIGINT) AS df_residual
FROM fit JOIN q USING (series)
""")
def model_summary(spark, sf):
    df = stats.model_summary(table(spark, sf, "lineitem"), SERIES, with_p=False)
    fine = ("r2", "adj_r2")
    return df.select("series", "df_residual", *(
        r6(c, digits=9 if c in fine else 5).alias(c) for c in df.columns if c not in ("series", "df_residual")
    ))


@query("""
WITH long AS (
  SELECT 'value' AS column_name, value AS v FROM events
  UNION ALL SELECT 'event_id', CAST(event_id AS DOUBLE) FROM events)
SELECT column_name, round(min(v), 6) AS lowest, round(quantile_cont(v, 0.25), 6) AS q1, round(median(v), 6) AS median,
       round(avg(v), 6) AS mean, round(quantile_cont(v, 0.75), 6) AS q3, round(max(v), 6) AS highest,
       count(*) - count(v) AS missing
FROM long GROUP BY 1
""")
def column_profile(spark, sf):
    df = stats.column_profile(table(spark, sf, "events"), ["value", "event_id"])
    return df.select("column_name", "missing", *(
        r6(c).alias(c) for c in ("lowest", "q1", "median", "mean", "q3", "highest")
    ))


@query(f"""
WITH {FIT_SQL}, long AS ({_LONG})
SELECT series, x, y, round(intercept + slope * x, 4) AS fitted, round(y - (intercept + slope * x), 6) AS residual
FROM long JOIN fit USING (series)
""")
def fitted_and_residuals(spark, sf):
    df = table(spark, sf, "lineitem")
    return stats.residuals(df, SERIES, stats.fit(df, SERIES)).select(
        "series", "x", "y", r6("fitted", digits=4).alias("fitted"), r6("residual", digits=6).alias("residual")
    )


@query("""
WITH per AS (SELECT c_name AS category, sum(o_totalprice) AS amount FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
run AS (SELECT *, sum(amount) OVER (ORDER BY category) AS upto, sum(amount) OVER () AS total FROM per)
SELECT category, round(amount / total, 9) AS share, round((upto - amount) / total * 360, 6) AS angle_start,
       round(upto / total * 360, 6) AS angle_end FROM run
""")
def shares_of_total(spark, sf):
    df = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    amounts = df.select(F.col("c_name").alias("category"), "o_totalprice")
    parts = stats.shares(amounts, "category", "o_totalprice")
    return parts.select(
        "category", r6("share", digits=9).alias("share"), r6("angle_start").alias("angle_start"), r6("angle_end").alias("angle_end")
    )


@query("""
SELECT p_partkey, round(0.3e0 + (row_number() OVER (ORDER BY p_partkey) - 1) * 0.7e0 / (count(*) OVER () - 1), 9) AS grey FROM part
""")
def grey_ramp(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey")
    ramp = stats.even_ramp(parts, ["p_partkey"], 0.3, 1.0, "grey")
    return ramp.withColumn("grey", r6("grey", digits=9))
