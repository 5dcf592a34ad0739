"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_HOT = 1000
TRACKED = 10_000


def hot_keys(df: DataFrame, on: list[str]) -> DataFrame:
    """(_mark, _parts): hashes of the keys that hold more than one task's share of the rows, and in how many parts.

    One pass of a mergeable heavy-hitter sketch: a key's count is wrong by at most 4 / ``TRACKED``
    of all rows, and at most ``MOST_HOT`` keys are hot. A share is that of one shuffle partition.
    """
    parts = min(MOST_HOT, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = df.select(F.xxhash64(*on).alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {MOST_HOT}, {TRACKED})").alias("_top"), F.count(F.lit(1)).alias("_all")
    )
    times = F.ceil(F.col("_hot")["count"] * parts / F.col("_all"))
    return (
        found.select("_all", F.explode("_top").alias("_hot"))
        .select(F.col("_hot")["item"].alias("_mark"), times.alias("_parts")).where(F.col("_parts") > 1)
    )


def salted_join(big: DataFrame, small: DataFrame, on: list[str], spread_by: list[str], how: str = "inner") -> DataFrame:
    """Join on ``on`` with the rows of a hot key of ``big`` spread over several tasks.

    Only the rows of ``small`` that have a hot key are repeated, once per part. The part of a row of ``big``
    depends only on the values of ``spread_by``, so a retried task gives the same rows.
    """
    hot = F.broadcast(hot_keys(big, on))  # at most MOST_HOT rows
    parts = F.coalesce(F.col("_parts"), F.lit(1).cast("bigint"))

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("_mark", F.xxhash64(*on)).join(hot, "_mark", "left")

    left = marked(big).withColumn("_salt", F.pmod(F.xxhash64(*spread_by), parts)).drop("_parts", "_mark")
    right = marked(small).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))).drop("_parts", "_mark")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def key_fanout(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows per key on both sides and the rows their join would give, without joining rows."""
    a = left.groupBy(*on).agg(F.count(F.lit(1)).alias("left_rows"))
    b = right.groupBy(*on).agg(F.count(F.lit(1)).alias("right_rows"))
    return a.join(b, on, "inner").withColumn("joined_rows", F.col("left_rows") * F.col("right_rows"))


def fanout_report(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """One row: keys that meet, rows going in, rows coming out, growth."""
    return key_fanout(left, right, on).agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum("left_rows").alias("left_rows"),
        F.sum("right_rows").alias("right_rows"),
        F.sum("joined_rows").alias("joined_rows"),
        F.try_divide(F.sum("joined_rows"), F.sum("left_rows")).alias("growth"),
    )
