"""Quality rules whose limits follow the data of each language and source.

A document gets four measures, all whole numbers: symbols per thousand word characters,
repeated lines per thousand lines, words in repeated windows per thousand words, and mean
word length in tenths of a character. For each (language, source) and measure a quantile
sketch counts the documents that pass the base rules per bin. Bins are whole numbers below 128 and a 64th of a power of
two wide above, so a sketch has some hundred counters at most, is exact to one part in
64, and merges by adding counters: it does not depend on how rows are dealt to tasks.

A measure's limit follows the spread of its sketch, as far above a high quantile as that
quantile lies above the median, times a factor: ``high + factor (high - median)``. Which quantile and
factor depends on the measure (``RULES``): rubbish of one kind, as symbols or endless words, can be some
per cent of a source, so the quantile has to be lower than that; repeats are no rubbish until they are far
more than what the source's own documents have. A document passes when all its
measures are at most their limits and it did not fail the base rules. The least distance is that from the
median below which rounding and a handful of characters or lines decide. A group with fewer than
``LEAST`` documents is judged by its language's sketch, a small language by that of all
documents.

Definitions for odd input: a null text is an empty one, has no words and fails. Null
language and source form groups of their own. Rows are judged one by one, so repeated rows
and repeated or null ids each give a row. An empty table gives an empty result. Other columns
play no part; ``passing`` keeps them, whatever their names.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placetime.functions.values import let
from placetime.llm.common import WHITE, quoted
from placetime.session import checkpointed, fresh_path

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of words
LEAST = 200
#: measure: per cent of its high quantile, factor in tenths, least distance from the median
RULES = {"symbols": (75, 30, 10), "dup_lines": (99, 10, 100), "repeats": (99, 15, 100), "word_length": (90, 40, 10)}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _covered(words: Column) -> Column:
    """How many words lie in a window that the text holds twice or more."""
    def by_place(ordered: Column) -> Column:
        """Places of the windows that equal a neighbour in hash order, ascending."""
        same = lambda x, i: F.coalesce((F.get(ordered, i - 1)["h"] == x["h"]) & (i > 0), F.lit(False)) | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.array_compact(F.transform(ordered, lambda x, i: F.when(same(x, i), x["i"]))))

    def total(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(placed, lambda p: let(by_place(p), total)))

    def windows(hashed: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(hashed) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashed, i, F.lit(WINDOW))))

    own = let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashed: let(windows(hashed), repeated))
    return F.when(F.size(words) >= WINDOW, own).otherwise(F.lit(0).cast("long"))


def counts(text: Column | str) -> Column:
    """Struct of the five base counts of a text and its lines with a word."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))

    def of_words(words: Column) -> Column:
        def of_letters(joined: Column) -> Column:
            return F.struct(F.length(joined).cast("long").alias("chars"), F.when(joined.rlike(r"[#*$%&|<>]"), F.length(joined) - F.length(F.regexp_replace(joined, r"[#*$%&|<>]+", ""))).otherwise(0).cast("long").alias("symbols"))

        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            let(F.array_join(words, ""), of_letters).alias("letters"),
            _covered(words).alias("n_repeat_words"),
        )

    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(WHITE)) != "")
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    words = let(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""), of_words)
    return let(F.struct(words.alias("w"), of_lines.alias("l")), lambda c: F.struct(
        c["w"]["n_words"].alias("n_words"), c["w"]["letters"]["chars"].alias("word_chars"), c["w"]["letters"]["symbols"].alias("n_symbols"),
        c["l"]["dup"].alias("n_dup_lines"), c["w"]["n_repeat_words"].alias("n_repeat_words"), c["l"]["n"].alias("n_lines"),
    ))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])


def measures(c: Column) -> Column:
    """Array of the four measures, in the order of RULES."""
    per = lambda top, scale, bottom: F.floor(F.lit(scale) * c[top] / F.greatest(c[bottom], F.lit(1)))
    return F.array(per("n_symbols", 1000, "word_chars"), per("n_dup_lines", 1000, "n_lines"), per("n_repeat_words", 1000, "n_words"), per("word_chars", 10, "n_words"))


def bin_of(value: Column) -> Column:
    """Least value of the sketch bin that holds a whole number."""
    width = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return F.when(value < 128, value).otherwise(F.call_function("shiftleft", F.call_function("shiftright", value, width), width))


def sketches(measured: DataFrame) -> DataFrame:
    """Counters (lang, source, measure, bin, n) of rows with lang, source and an array of measures."""
    return (
        # outer: else Spark filters on the array first, and works it out again for that
        measured.select("lang", "source", F.posexplode_outer("measures").alias("measure", "value"))
        .where(F.col("value").isNotNull()).groupBy("lang", "source", "measure", bin_of(F.col("value")).alias("bin")).agg(F.count("*").alias("n"))
    )


def merged(counters: DataFrame, *by: str) -> DataFrame:
    """The sketch of several groups together: their counters added."""
    return counters.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))


def _rule(part: int) -> Column:
    return F.element_at(F.array(*[F.lit(r[part]) for r in RULES.values()]), F.col("measure") + 1)


def quantiles(counters: DataFrame, *by: str) -> DataFrame:
    """Per group and measure: total, median and the measure's high quantile, the least bins that reach them."""
    upto = W.partitionBy(*by, "measure").orderBy("bin")
    ranked = counters.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(W.partitionBy(*by, "measure")))
    reach = lambda per_cent: F.min(F.when(100 * F.col("upto") >= per_cent * F.col("total"), F.col("bin")))
    return ranked.groupBy(*by, "measure").agg(F.max("total").alias("total"), reach(F.lit(50)).alias("median"), reach(_rule(0)).alias("high"))


def limits(measured: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, source, limits): an array with the limit of each measure, a row per group.

    ``measured`` has the documents that pass the base rules, and a group in which none does has no row.
    """
    own = checkpointed(sketches(measured))
    langs = checkpointed(merged(own, "lang"))
    q = F.struct("total", "median", "high")
    per_group = quantiles(own, "lang", "source").select("lang", "source", "measure", q.alias("own"))
    per_lang = quantiles(langs, "lang").select(F.col("lang").alias("of_lang"), F.col("measure").alias("m1"), q.alias("wide"))
    overall = quantiles(merged(langs)).select(F.col("measure").alias("m2"), q.alias("widest"))
    chosen = F.when(F.col("own.total") >= least, F.col("own")).when(F.col("wide.total") >= least, F.col("wide")).otherwise(F.col("widest"))
    spread = F.col("q.high") - F.col("q.median")
    joined = (
        per_group.join(per_lang, F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("measure") == F.col("m1")))
        .join(overall, F.col("measure") == F.col("m2")).withColumn("q", chosen)
        .withColumn("top", F.greatest(F.col("q.high") + F.floor(spread * _rule(1) / 10), F.col("q.median") + _rule(2)))
    )
    return joined.groupBy("lang", "source").agg(F.transform(F.array_sort(F.collect_list(F.struct("measure", "top"))), lambda x: x["top"]).alias("limits"))


def within(found: Column, tops: Column) -> Column:
    """All measures are at most their limits."""
    return F.forall(F.arrays_zip(found.alias("v"), tops.alias("t")), lambda x: x["v"] <= x["t"])


def judged(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, the five counts, base_failed and kept for every row of ``docs`` (doc_id, text, lang, source)."""
    measured = checkpointed(
        docs.select("doc_id", "lang", "source", counts("text").alias("c"))
        .select("doc_id", "lang", "source", "c", base_failed(F.col("c")).alias("base_failed"), measures(F.col("c")).alias("measures"))
    )
    tops = limits(measured.where("not base_failed"), least).withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    both = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    kept = ~F.col("base_failed") & within(F.col("measures"), F.col("limits"))
    return measured.join(tops, both, "left").select("doc_id", *[f"c.{n}" for n in COUNTS], "base_failed", F.coalesce(kept, F.lit(False)).alias("kept"))


def passing(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns unchanged.

    The limits are written first, so Spark knows their size when it plans the join: they are
    sent to all tasks where they are small, and joined by shuffle where they are not.
    """
    good = lambda c: F.when(~base_failed(c), measures(c))
    measured = docs.select("lang", "source", let(counts("text"), good).alias("measures"))
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "quality-limits")
    limits(measured, least).write.parquet(path)
    tops = spark.read.parquet(path)
    joined = docs.join(tops, docs["lang"].eqNullSafe(tops["lang"]) & docs["source"].eqNullSafe(tops["source"]))
    keep = let(counts(docs["text"]), lambda c: ~base_failed(c) & within(measures(c), tops["limits"]))
    return joined.where(keep).select(*[docs[quoted(c)] for c in docs.columns])


_MEASURES = {
    "symbols": "1000 * n_symbols // greatest(word_chars, 1)",
    "dup_lines": "1000 * n_dup_lines // greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words // greatest(n_words, 1)",
    "word_length": "10 * word_chars // greatest(n_words, 1)",
}


def _sql_rows() -> str:
    """Shared first part of the SQL check: every document with its counts and measures."""
    values = ", ".join(f"{{'measure': {i}, 'value': {e}, 'rank': {p}, 'factor': {k}, 'least': {d}}}" for i, (e, (p, k, d)) in enumerate(zip(_MEASURES.values(), RULES.values(), strict=True)))
    return rf"""
    d AS (SELECT row_number() OVER () AS row_id, *, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
    wins AS (SELECT row_id, p, array_to_string(words[p:p + {WINDOW - 1}], ' ') AS win FROM (SELECT row_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS p FROM w)),
    twice AS (SELECT row_id, p FROM (SELECT row_id, p, count(*) OVER (PARTITION BY row_id, win) AS k FROM wins) WHERE k > 1),
    cover AS (SELECT row_id, sum(least({WINDOW}, coalesce(nxt - p, {WINDOW})))::BIGINT AS n FROM (SELECT row_id, p, lead(p) OVER (PARTITION BY row_id ORDER BY p) AS nxt FROM twice) GROUP BY row_id),
    c AS (SELECT w.*, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words
        FROM w LEFT JOIN cover USING (row_id)),
    f AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM c),
    m AS (SELECT row_id, lang, source, unnest([{values}], recursive := true) FROM f WHERE NOT base_failed),
    s AS (SELECT *, CASE WHEN value < 128 THEN value ELSE (value >> (length(bin(value)) - 7)::INT) << (length(bin(value)) - 7)::INT END AS bin FROM m),
    u AS (SELECT 0 AS kind, lang, source, measure, rank, factor, least, bin FROM s UNION ALL SELECT 1, lang, NULL, measure, rank, factor, least, bin FROM s UNION ALL SELECT 2, NULL, NULL, measure, rank, factor, least, bin FROM s),
    r AS (SELECT *, row_number() OVER (PARTITION BY kind, lang, source, measure ORDER BY bin) AS k, count(*) OVER (PARTITION BY kind, lang, source, measure) AS total FROM u),
    q AS (SELECT kind, lang, source, measure, total, greatest(min(bin) FILTER (100 * k >= rank * total) + (min(bin) FILTER (100 * k >= rank * total) - min(bin) FILTER (100 * k >= 50 * total)) * factor // 10,
            min(bin) FILTER (100 * k >= 50 * total) + least) AS top FROM r GROUP BY kind, lang, source, measure, total, factor, least),
    bad AS (SELECT DISTINCT s.row_id FROM s
        JOIN q a ON a.kind = 0 AND a.measure = s.measure AND a.lang IS NOT DISTINCT FROM s.lang AND a.source IS NOT DISTINCT FROM s.source
        JOIN q b ON b.kind = 1 AND b.measure = s.measure AND b.lang IS NOT DISTINCT FROM s.lang
        JOIN q e ON e.kind = 2 AND e.measure = s.measure
        WHERE s.value > CASE WHEN a.total >= {LEAST} THEN a.top WHEN b.total >= {LEAST} THEN b.top ELSE e.top END)"""


SQL = f"""WITH {_sql_rows()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND row_id NOT IN (SELECT row_id FROM bad) AS kept FROM f"""
