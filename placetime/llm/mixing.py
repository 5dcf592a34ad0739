"""Mixing sources to target weights by Poisson replication.

Every source gets a target share of the output's characters. Its repetition rate is that
share's characters over the characters it has; each document then appears k times, where k
is the Poisson distribution with that mean, inverted at a number that a hash of the document
and the seed gives. The expected output of a source is its target, every document decides
alone, and a run that is repeated gives the same rows. Copies are dealt to partitions and
ordered within them by a second hash, which is a global shuffle.

Target weights: a table of (source, weight) or, without one, ``size ** flatness`` of every
source, the usual way to lift small sources. Weights need not add up to one. A source that
a given table leaves out gets weight 0 and no rows; a weight of a source without documents
is spread over the others by the shares. The output has as many characters as the input
has, in expectation, or ``total`` where given.

Definitions for odd input: a null source is a source of its own (weight under null). A null
text has no characters, and so has an empty one; for both, one character is counted, so a
source of empty documents has a size. Rows with equal doc_id and text get the same k. A null
doc_id hashes as an empty string. An empty table gives an empty result. Other columns are
kept as they are, whatever their names.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetime.functions.values import let
from placetime.llm.common import every, free_name, quoted
from placetime.session import checkpointed, fresh_path

FLATNESS = 0.7
SEED = 42


def uniform(key: Column, seed: int, part: Column) -> Column:
    """A number above 0 and below 1 from the first 52 bits of an MD5 of key, seed and part."""
    digest = F.md5(F.concat(key, F.lit(f":{seed}:"), part.cast("string"), F.lit(":u")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def poisson_steps(rate: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2, ... as far as doubles tell them from one.

    ``rate`` must be moderate, so that exp(-rate) does not vanish.
    """
    far = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("steps"))
    grown = F.aggregate(
        F.sequence(F.lit(1), far), start,
        lambda a, k: F.struct((a["p"] * rate / k).alias("p"), F.concat(a["steps"], F.array(F.element_at(a["steps"], -1) + a["p"] * rate / k)).alias("steps")),
    )
    return grown["steps"]


def rates(docs: DataFrame, weights: DataFrame | None = None, flatness: float = FLATNESS, total: float | None = None) -> DataFrame:
    """(source, size, share, rate) of every source of ``docs``."""
    sizes = docs.groupBy("source").agg(F.sum(F.greatest(F.length("text"), F.lit(1)).cast("long")).alias("size"))
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(flatness)))
    else:
        given = weights.select(F.col("source").alias("given"), F.col("weight").cast("double").alias("weight"))
        weighted = sizes.join(given, F.col("source").eqNullSafe(F.col("given")), "left").select("source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    weighted = checkpointed(weighted)
    weights_sum, characters = weighted.agg(F.sum("weight"), F.sum("size")).first()
    share = F.col("weight") / F.lit(weights_sum or 1.0)
    return weighted.select("source", "size", share.alias("share"), (share * F.lit(float(total or characters or 0)) / F.col("size")).alias("rate"))


def repetitions(docs: DataFrame, of: DataFrame, seed: int = SEED, name: str = "copies") -> DataFrame:
    """``docs`` with the number of times each row is to appear, by the rates in ``of``.

    A rate above 400 is the sum of equal smaller Poisson numbers, each with its own hash.
    """
    parts = F.ceil(F.col("rate") / 400).cast("int")
    table = of.select(
        F.col("source").alias("of_source"), F.greatest(parts, F.lit(1)).alias("parts"),
        poisson_steps(F.col("rate") / F.greatest(parts, F.lit(1))).alias("steps"),
    )
    key = F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit(":"), F.coalesce(docs["text"], F.lit("")))
    digest = free_name(docs, "digest")
    marked = docs.select(*every(docs), F.md5(key).alias(digest))
    joined = marked.join(table, marked["source"].eqNullSafe(table["of_source"]))
    k = F.aggregate(
        F.sequence(F.lit(1), table["parts"]), F.lit(0),
        lambda total, part: total + let(uniform(marked[digest], seed, part), lambda u: F.size(F.filter(table["steps"], lambda s: s < u))),
    )
    return joined.select(*[marked[quoted(c)] for c in docs.columns], marked[digest], k.alias(name))


def mixed(docs: DataFrame, weights: DataFrame | None = None, flatness: float = FLATNESS, total: float | None = None, seed: int = SEED) -> DataFrame:
    """The columns of ``docs`` after replication and shuffle.

    The rates are written first, so Spark knows their size when it plans the join: they go
    to all tasks where they are small, and are joined by shuffle where they are not.
    """
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "source-rates")
    rates(docs, weights, flatness, total).write.parquet(path)
    copies, order, copy = (free_name(docs, n) for n in ("copies", "order", "copy"))
    counted = repetitions(docs, spark.read.parquet(path), seed, copies)
    digest = counted.columns[-2]
    # outer: else Spark filters on the array first, and draws the numbers again for that
    each = counted.select("*", F.posexplode_outer(F.array_repeat(F.lit(0), F.col(copies))).alias(copy, free_name(docs, "zero"))).where(F.col(copy).isNotNull())
    dealt = each.withColumn(order, F.md5(F.concat(F.col(digest), F.lit(f":{seed}:"), F.col(copy).cast("string"))))
    return dealt.repartition(F.col(order)).sortWithinPartitions(order).select(*[F.col(quoted(c)) for c in docs.columns])


#: SQL for the rows of ``mixed`` with the settings above; {source} is a table of documents.
STEPS_SQL = """
    sized AS (SELECT source, sum(greatest(coalesce(length(text), 1), 1))::DOUBLE AS size FROM {source} GROUP BY source),
    shared AS (SELECT source, size, pow(size, {flatness}) / sum(pow(size, {flatness})) OVER () AS share, sum(size) OVER () AS whole FROM sized),
    rated AS (SELECT source, share * whole / size AS rate, greatest(ceil(share * whole / size / 400), 1)::INT AS parts FROM shared),
    drawn AS (SELECT d.*, r.rate / r.parts AS rate, unnest(range(1, r.parts + 1)) AS part, md5(concat(coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))) AS digest
        FROM (SELECT row_number() OVER () AS row_id, * FROM {source}) d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source),
    tried AS (SELECT *, (('0x' || substr(md5(concat(digest, ':{seed}:', part, ':u')), 1, 13))::BIGINT + 0.5) / 4503599627370496e0 AS u FROM drawn),
    law AS (SELECT DISTINCT rate FROM drawn),
    grown AS (SELECT rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY rate ORDER BY k) AS upto
        FROM (SELECT rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::INT + 1)) AS k FROM law)),
    copied AS (SELECT row_id, any_value(doc_id) AS doc_id, any_value(text) AS text, any_value(lang) AS lang, any_value(source) AS source, any_value(n_chars) AS n_chars, sum((SELECT count(*) FROM grown g WHERE g.rate = tried.rate AND g.upto < tried.u))::INT AS k
        FROM tried GROUP BY row_id)"""


def sql(source: str, flatness: float = FLATNESS, seed: int = SEED) -> str:
    """Common table expressions that end in ``copied``: each row of ``source`` with its number k."""
    return STEPS_SQL.format(source=source, flatness=flatness, seed=seed)
