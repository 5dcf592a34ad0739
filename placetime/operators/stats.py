"""Regression tables, profiles and shares from mergeable sums."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetime.functions import values
from placetime.operators.ordered import exact_quantiles, ordered_columns, quantile_sketch
from placetime.session import checkpointed

Series = dict[str, tuple[str, str]]
QUARTILES = [0.25, 0.5, 0.75]


def long_series(df: DataFrame, series: Series) -> DataFrame:
    """Column pairs as rows of ``series, x, y``."""
    pairs = F.array(*(
        F.struct(F.lit(name).alias("series"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        for name, (x, y) in series.items()
    ))
    return df.select(F.inline(pairs))


def sufficient_sums(df: DataFrame, series: Series) -> DataFrame:
    """One row per series: count, means and centred sums, in one scan of the wide table."""
    made = []
    for i, (x, y) in enumerate(series.values()):
        fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
        made += [
            F.regr_count(fy, fx).alias(f"n{i}"),
            F.regr_avgx(fy, fx).alias(f"mx{i}"),
            F.regr_avgy(fy, fx).alias(f"my{i}"),
            F.regr_sxx(fy, fx).alias(f"sxx{i}"),
            F.regr_syy(fy, fx).alias(f"syy{i}"),
            F.regr_sxy(fy, fx).alias(f"sxy{i}"),
        ]
    parts = ("n", "mx", "my", "sxx", "syy", "sxy")
    rows = F.array(*(
        F.struct(F.lit(name).alias("series"), *(F.col(f"{p}{i}").alias(p) for p in parts))
        for i, name in enumerate(series)
    ))
    return df.agg(*made).select(F.inline(rows))


def fit(df: DataFrame, series: Series) -> DataFrame:
    """Least squares per series: slope, intercept and the sums behind every other table."""
    sums = sufficient_sums(df, series)
    slope = F.try_divide(F.col("sxy"), F.col("sxx"))
    return (
        sums.withColumn("slope", slope)
        .withColumn("intercept", F.col("my") - F.col("slope") * F.col("mx"))
        .withColumn("ssr", F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx")))
        .withColumn("sse", F.greatest(F.lit(0.0), F.col("syy") - F.col("ssr")))
        .withColumn("df_residual", F.col("n") - 2)
        .withColumn("mse", F.when(F.col("df_residual") > 0, F.col("sse") / F.nullif(F.col("df_residual"), F.lit(0))))
        .withColumn("r2", F.try_divide(F.col("ssr"), F.col("syy")))
    )


def fit_by(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """One least-squares line per group of rows."""
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    return df.groupBy(*keys).agg(
        F.regr_count(fy, fx).alias("n"), F.regr_slope(fy, fx).alias("slope"),
        F.regr_intercept(fy, fx).alias("intercept"), F.regr_r2(fy, fx).alias("r2"),
    )


def _continued_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(tiny, 1.0 - (a + b) * x / (a + 1.0), key=abs)
    value = d
    for m in range(1, 100_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for term in (even, odd):
            d = 1.0 / max(tiny, 1.0 + term * d, key=abs)
            c = max(tiny, 1.0 + term / c, key=abs)
            step = c * d
            value *= step
        if abs(step - 1.0) < 1e-15:
            return value
    raise ArithmeticError(f"tail probability does not settle for {a}, {b}, {x}")


def _log_gamma_ratio(a: float, b: float) -> float:
    """log(gamma(a + b) / gamma(a)), without the difference of two large logarithms."""
    if a < 50:
        return math.lgamma(a + b) - math.lgamma(a)

    def rest(z: float) -> float:
        return (1 - (1 / 30 - (2 / 105 - 1 / (140 * z * z)) / (z * z) / 2) / (z * z)) / (12 * z)

    return (a + b - 0.5) * math.log1p(b / a) + b * (math.log(a) - 1) + rest(a + b) - rest(a)


def _gamma_tail(b: float, z: float) -> float:
    """Upper tail of the gamma distribution with shape ``b``."""
    front = math.exp(b * math.log(z) - z - math.lgamma(b))
    if z < b + 1:
        term = total = 1 / b
        k = b
        while abs(term) > 1e-17 * abs(total):
            k += 1
            term *= z / k
            total += term
        return 1 - front * total
    tiny = 1e-300
    at = z + 1 - b
    c, d = 1 / tiny, 1 / at
    value = d
    for i in range(1, 100_000):
        part = -i * (i - b)
        at += 2
        d = 1 / max(tiny, part * d + at, key=abs)
        c = max(tiny, at + part / c, key=abs)
        value *= c * d
        if abs(c * d - 1) < 1e-15:
            return front * value
    raise ArithmeticError(f"tail probability does not settle for {b}, {z}")


def _beta_cdf(a: float, b: float, x: float, y: float) -> float:
    """Incomplete beta function at ``x``; ``y`` is 1 - x, given apart to keep its digits."""
    if x <= 0.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    log_x, log_y = (math.log1p(-y), math.log(y)) if y < 0.5 else (math.log(x), math.log1p(-x))
    if a > 1e5 * max(1.0, b * b):  # with so many rows the gamma limit has an error of about 1 / a ** 2
        return _gamma_tail(b, -(a + (b - 1) / 2) * log_x)
    ratio = _log_gamma_ratio(a, b) - math.lgamma(b) if a > b else _log_gamma_ratio(b, a) - math.lgamma(a)
    front = math.exp(ratio + a * log_x + b * log_y)
    if x < (a + 1) / (a + b + 2):
        return front * _continued_fraction(a, b, x) / a
    return 1.0 - front * _continued_fraction(b, a, y) / b


def _f_tail(f: float, df1: float, df2: float) -> float:
    if not (np.isfinite(f) and df1 > 0 and df2 > 0):
        return math.nan
    return _beta_cdf(df2 / 2, df1 / 2, df2 / (df2 + df1 * f), df1 * f / (df2 + df1 * f))


def f_p_value(f: Column, df1: Column, df2: Column) -> Column:
    """Upper tail of the F distribution, for tables of a few rows per series."""

    @F.pandas_udf("double")
    def tail(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
        out = [_f_tail(*row) for row in zip(f.astype(float), df1.astype(float), df2.astype(float))]
        return pd.Series(out, dtype="float64").replace({np.nan: None}).astype("float64")

    p = tail(f.cast("double"), df1.cast("double"), df2.cast("double"))
    return F.when(f.isNotNull() & (df2 > 0), p)


def anova(fitted: DataFrame, with_p: bool = True) -> DataFrame:
    """Two rows per series: the term and the residuals."""
    f_value = F.try_divide(F.col("ssr"), F.col("mse"))
    rows = F.array(
        F.struct(
            F.lit("x").alias("term"), F.lit(1).cast("bigint").alias("df"), F.col("ssr").alias("sum_sq"),
            F.col("ssr").alias("mean_sq"), f_value.alias("f_value"),
        ),
        F.struct(
            F.lit("Residuals").alias("term"), F.col("df_residual").alias("df"), F.col("sse").alias("sum_sq"),
            F.col("mse").alias("mean_sq"), F.lit(None).cast("double").alias("f_value"),
        ),
    )
    table = fitted.select("series", "df_residual", F.inline(rows))
    if with_p:
        table = table.withColumn("p_value", f_p_value(F.col("f_value"), F.col("df"), F.col("df_residual")))
    return table.drop("df_residual")


def coefficient_matrix(fitted: DataFrame, names: list[str]) -> DataFrame:
    """Terms as rows, series as columns."""
    return (
        fitted.unpivot(["series"], ["intercept", "slope"], "term", "estimate")
        .groupBy("term").pivot("series", names).agg(F.first("estimate"))
    )


def coefficient_table(fitted: DataFrame, with_p: bool = True) -> DataFrame:
    """Estimate, standard error and t per series and term."""
    se_slope = F.sqrt(F.try_divide(F.col("mse"), F.col("sxx")))
    se_intercept = F.sqrt(F.col("mse") * (1 / F.col("n") + F.try_divide(F.col("mx") * F.col("mx"), F.col("sxx"))))
    rows = F.array(
        F.struct(F.lit("intercept").alias("term"), F.col("intercept").alias("estimate"), se_intercept.alias("std_error")),
        F.struct(F.lit("slope").alias("term"), F.col("slope").alias("estimate"), se_slope.alias("std_error")),
    )
    table = fitted.select("series", "df_residual", F.inline(rows)).withColumn(
        "t_value", F.try_divide(F.col("estimate"), F.col("std_error"))
    )
    if with_p:
        squared = F.col("t_value") * F.col("t_value")
        table = table.withColumn("p_value", f_p_value(squared, F.lit(1), F.col("df_residual")))
    return table.drop("df_residual")


def residuals(df: DataFrame, series: Series, fitted: DataFrame) -> DataFrame:
    """Fitted value and residual of every observation.

    The coefficient side has one row per series named in the call.
    """
    lines = fitted.select("series", "slope", "intercept")
    return (
        long_series(df, series).join(F.broadcast(lines), "series")
        .withColumn("fitted", F.col("intercept") + F.col("slope") * F.col("x"))
        .withColumn("residual", F.col("y") - F.col("fitted"))
        .select("series", "x", "y", "fitted", "residual")
    )


def wide_residuals(df: DataFrame, series: Series, fitted: DataFrame) -> DataFrame:
    """Residuals as one column per series, without repeating the rows."""
    # one struct field per series named in the call
    lines = fitted.agg(F.struct(*(
        F.struct(*(F.max(F.when(F.col("series") == name, F.col(c))).alias(c) for c in ("slope", "intercept"))).alias(name)
        for name in series
    ))).scalar()
    return df.withColumn("_lines", lines).select(*(
        (F.col(y) - F.col("_lines")[name]["intercept"] - F.col("_lines")[name]["slope"] * F.col(x)).alias(name)
        for name, (x, y) in series.items()
    ))


def model_summary(df: DataFrame, series: Series, with_p: bool = True) -> DataFrame:
    """Residual five-number summary, residual standard error, R2, adjusted R2 and F.

    ``df`` is read three times: for the lines, a sketch of the residuals, and their exact quartiles.
    """
    fitted = checkpointed(fit(df, series))
    wide = wide_residuals(df, series, fitted)
    sketch = checkpointed(quantile_sketch(wide, list(series), QUARTILES))
    per_series = sketch.select(F.inline(F.array(*(
        F.struct(F.lit(s).alias("series"), F.col(s)["lowest"].alias("res_min"), F.col(s)["highest"].alias("res_max")) for s in series
    ))))
    quartiles = (
        exact_quantiles(wide, list(series), QUARTILES, sketch=sketch)
        .groupBy("column_name").pivot("probability", QUARTILES).agg(F.first("quantile"))
        .toDF("series", "res_q1", "res_median", "res_q3")
    )
    f_value = F.try_divide(F.col("ssr"), F.col("mse"))
    table = (
        fitted.join(per_series, "series").join(quartiles, "series")
        .select(
            "series", "res_min", "res_q1", "res_median", "res_q3", "res_max",
            F.sqrt("mse").alias("res_std_error"), "r2",
            (1 - (1 - F.col("r2")) * F.try_divide(F.col("n") - 1, F.col("df_residual"))).alias("adj_r2"),
            f_value.alias("f_value"), "df_residual",
        )
    )
    if with_p:
        table = table.withColumn("p_value", f_p_value(F.col("f_value"), F.lit(1), F.col("df_residual")))
    return table


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum, quartiles, median, mean, maximum and missing count per column; ``df`` is read twice."""
    sketch = checkpointed(quantile_sketch(df, columns, QUARTILES))
    basics = sketch.select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("column_name"), *(F.col(c)[f].alias(f) for f in ("lowest", "mean", "highest", "missing"))) for c in columns
    ))))
    quartiles = (
        exact_quantiles(df, columns, QUARTILES, sketch=sketch)
        .groupBy("column_name").pivot("probability", QUARTILES).agg(F.first("quantile"))
        .toDF("column_name", "q1", "median", "q3")
    )
    return basics.join(quartiles, "column_name", "left").select(
        "column_name", "lowest", "q1", "median", "mean", "q3", "highest", "missing"
    )


def shares(df: DataFrame, category: str, value: str) -> DataFrame:
    """Share of the total per category, with start and end angle in category order; ``df`` is read once."""
    per_category = checkpointed(df.groupBy(category).agg(F.sum(value).alias("amount")))
    run = ordered_columns(per_category, [], [category], running={"upto": "amount"})
    total = per_category.agg(F.sum("amount")).scalar()
    return run.withColumn("total", total).select(
        category,
        (F.col("amount") / F.col("total")).alias("share"),
        ((F.col("upto") - F.col("amount")) / F.col("total") * 360).alias("angle_start"),
        (F.col("upto") / F.col("total") * 360).alias("angle_end"),
    )


def even_ramp(df: DataFrame, order: list[str], low: float, high: float, into: str) -> DataFrame:
    """Evenly spaced values from low to high in row order."""
    ranked = ordered_columns(df, [], order, rank="_position")
    size = df.agg(F.count(F.lit(1))).scalar()
    return (
        ranked.withColumn("_size", size)
        .withColumn(into, values.ramp("_position", "_size", low, high))
        .drop("_position", "_size")
    )
