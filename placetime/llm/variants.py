"""Spelling variants: words of a corpus that lie one edit apart, and the usual form of each.

Words are counted over all texts. Two words are near when one inserted, deleted or replaced
code point makes them equal. Words that can be near share all but a stretch of their code
points: a key is a length, a stretch and the code points outside it, and a word enters the
keys of its own length as the shorter one of a pair and those of one less as the longer one.
At first a word has two stretches, its halves. A key that holds more than ``CROWD`` words is
cut again: its words go into the keys of the two halves of its stretch, until the stretch is
one code point, so no key grows with the vocabulary whatever the words share.

Rows are dealt by key and sorted by key and stretch. A task scans each key's sorted list by
dynamic programming: the rows of the edit matrix of a word against its list, three cells wide,
are kept for as many code points as the next entry shares with the last one, and entries that share
a beginning which already costs more than one edit are passed over together. A pair is given
out by the one key whose stretch holds the first place at which its words differ.

The form of a word is the most frequent of its near words if that is ``FACTOR`` times as frequent
as the word. Forms are followed by doubling: each round joins every word's last form with the
forms of forms, and frequencies grow along the way, so the rounds are few and there is no circle.

Definitions for odd input: a null text has no words. A null doc_id hashes as an empty string.
Repeated rows count as often as they stand. An empty table gives an empty result. Columns other
than doc_id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetime.session import checkpointed

SLIPS = 199  # one in so many runs loses a code point
LENGTH = 6  # code points of the shortest word
LEAST = 5  # occurrences of the rarest word
FACTOR = 5  # how much more frequent a form is than its word
CROWD = 64  # words of a key that is not cut again
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(text: Column | str) -> Column:
    """Maximal runs of Latin letters, A-Z in lower case."""
    return F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[^a-zÀ-ÿ]+")


def slipped(doc_id: Column, run: Column, one_in: int = SLIPS) -> Column:
    """The run, without one code point where the checksum of document and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(docs: DataFrame, one_in: int = SLIPS, length: int = LENGTH, least: int = LEAST) -> DataFrame:
    """(word, n) of the words of all texts, counted per task before they are dealt."""
    # outer: else Spark filters on the array first, and works it out again for that
    found = docs.select("doc_id", F.explode_outer(runs("text")).alias("run")).where(F.length("run") >= length)
    return (
        found.select(slipped(F.col("doc_id"), F.col("run"), one_in).alias("word")).where(F.length("word") >= length)
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    )


def _members(words: DataFrame) -> DataFrame:
    """Every word under the two halves of its own length, and of one less."""
    roles = words.withColumn("longer", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("size", F.length("word") - F.col("longer"))
    half = F.floor(F.col("size") / 2).cast("int")
    halves = F.array(F.struct(F.lit(0).alias("i"), half.alias("j")), F.struct(half.alias("i"), F.col("size").alias("j")))
    return roles.withColumn("part", F.explode(halves)).select("word", "n", "longer", "size", "part.i", "part.j")


def _keyed(members: DataFrame) -> DataFrame:
    outside = F.concat(F.substr("word", F.lit(1), F.col("i")), F.lit("\0"), F.substr("word", F.col("j") + F.col("longer") + 1))
    return members.withColumn("key", F.concat_ws(",", "size", "i", outside))


def dealt(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(key, word, n, longer, size, i, j) of every key that can hold a pair, crowded keys cut again."""
    left, done = checkpointed(_keyed(_members(words))), None
    while True:
        counted = left.groupBy("key").agg(F.count("*").alias("rows"), F.min("longer").alias("least"), F.max(F.col("j") - F.col("i")).alias("open"))
        cut = (F.col("rows") > crowd) & (F.col("open") > 1)
        # a key of one word, or of longer words alone, holds no pair of its own
        some = checkpointed(counted.where("rows > 1 and least = 0").select("key", cut.alias("cut")))
        here = left.join(some, "key")
        calm = here.where("not cut").drop("cut")
        done = calm if done is None else done.union(calm)
        if not some.where("cut").limit(1).count():
            return done
        middle = F.floor((F.col("i") + F.col("j")) / 2).cast("int")
        parts = F.array(F.struct("i", middle.alias("j")), F.struct(middle.alias("i"), "j"))
        halves = here.where("cut").withColumn("part", F.explode(parts)).select("word", "n", "longer", "size", "part.i", "part.j")
        left = checkpointed(_keyed(halves))


def shared(a: str, b: str) -> int:
    """Length of the longest common beginning."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def near(word: str, entries: list[str], lcps: list[int]) -> Iterator[int]:
    """Places in a sorted list whose entry is at most one edit from ``word``.

    ``lcps`` has the common beginning of every entry and the one before it. Row d holds the costs of the
    entry's first d code points against d - 1, d and d + 1 of the word's; a row that costs more than one
    edit everywhere is the last, and the entries that share it are passed over.
    """
    size, far = len(word), 2
    rows, place, count = [(far, 0, 1)], 0, len(entries)
    while place < count:
        entry = entries[place]
        del rows[min(lcps[place], len(rows) - 1) + 1:]
        over = 0
        for d in range(len(rows), len(entry) + 1):
            c, (low, same, high) = entry[d - 1], rows[-1]
            # word places d - 1, d, d + 1 against the entry's d-th code point
            left = min(low + (1 < d <= size + 1 and word[d - 2] != c), same + 1) if 0 < d <= size + 1 else far
            here = min(same + (word[d - 1] != c), left + 1, high + 1) if d <= size else far
            right = min(high + (word[d] != c), here + 1) if d + 1 <= size else far
            if left > 1 and here > 1 and right > 1:
                over = d
                break
            rows.append((left, here, right))
        if over:
            place += 1
            while place < count and lcps[place] >= over:
                place += 1
            continue
        gap = size - len(entry)
        if -1 <= gap <= 1 and rows[len(entry)][gap + 1] <= 1:
            yield place
        place += 1


def _scan(group: list[tuple]) -> Iterator[tuple]:
    """Pairs of one key; rows (word, n, longer, size, i, j) sorted by their stretch."""
    size, i, j = group[0][3:6]
    entries = [w[i:j + longer] for w, _, longer, *_ in group]
    lcps = [0, *(shared(a, b) for a, b in zip(entries, entries[1:], strict=False))]
    for place, (word, n, longer, *_) in enumerate(group):
        if longer:
            continue
        for other in near(entries[place], entries, lcps):
            mate, m, more = group[other][:3]
            if not more and other <= place:  # words of one length: each pair once, no word with itself
                continue
            at = shared(word, mate)
            if i <= at < j or at == j == size:
                yield word, n, mate, m


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    group, key = [], None

    def made(pairs: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*pairs, strict=True)) or [(), (), (), ()]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["u", "nu", "v", "nv"])

    for batch in batches:
        pairs = []
        for own, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != key:
                pairs += _scan(group) if group else ()
                group, key = [], own
            group.append(tuple(row))
        yield made(pairs)
    yield made(list(_scan(group)) if group else [])


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(u, nu, v, nv): every pair of ``words`` (word, n) that is one edit apart, once."""
    stretch = F.substr("word", F.col("i") + 1, F.col("j") + F.col("longer") - F.col("i"))
    lists = dealt(words, crowd).withColumn("stretch", stretch).repartition("key").sortWithinPartitions("key", "stretch", "longer")
    return lists.select("key", "word", "n", "longer", "size", "i", "j").mapInArrow(_scanned, "u string, nu long, v string, nv long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms of every word that has one, from (word, form)."""
    now = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = checkpointed(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return now


def variants(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of ``docs``."""
    words = checkpointed(vocabulary(docs))
    pairs = checkpointed(near_pairs(words, crowd))
    both = pairs.union(pairs.select("v", "nv", "u", "nu"))
    # least of (-n, word): the most frequent near word, of equal ones the first in order
    best = both.groupBy(F.col("u").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("nv")).alias("n"), F.col("v").alias("word"))).alias("top"))
    chosen = F.col("n_near").isNotNull() & (-F.col("top.n") >= FACTOR * F.col("n"))
    found = checkpointed(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("top.word")).alias("form"), F.when(chosen, -F.col("top.n")).alias("form_n"),
    ))
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


SQL = f"""WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT)) AS t),
r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
d AS (SELECT id, run, count(*) AS k, hex(encode(id || ':' || run)) AS x FROM r WHERE length(run) >= {LENGTH} GROUP BY ALL),
h AS (SELECT run, k, xor(list_reduce(list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i::INT + 1, 2))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM d, crc),
s AS (SELECT CASE WHEN h % {SLIPS} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM h),
w AS (SELECT word, sum(k)::BIGINT AS n FROM s WHERE length(word) >= {LENGTH} GROUP BY word HAVING sum(k) >= {LEAST}),
o AS (SELECT word, n, p, substr(word, 1, p - 1) AS a, substr(word, p + 1) AS z FROM (SELECT *, unnest(range(1, length(word) + 1)) AS p FROM w)),
e AS (SELECT x.word AS u, y.word AS v, y.n AS m FROM o x JOIN o y ON x.p = y.p AND x.a = y.a AND x.z = y.z AND x.word <> y.word
    UNION SELECT o.word, w.word, w.n FROM o JOIN w ON w.word = o.a || o.z
    UNION SELECT w.word, o.word, o.n FROM o JOIN w ON w.word = o.a || o.z),
f AS (SELECT word, n, count(v) AS n_near, first(v ORDER BY m DESC, v) AS top, max(m) AS most FROM w LEFT JOIN e ON e.u = w.word GROUP BY word, n),
g AS (SELECT word, n, n_near, CASE WHEN most >= {FACTOR} * n THEN top END AS form, CASE WHEN most >= {FACTOR} * n THEN most END AS form_n FROM f),
c AS (SELECT word, form AS reached, 1 AS step FROM g WHERE form IS NOT NULL UNION ALL SELECT c.word, g.form, c.step + 1 FROM c JOIN g ON g.word = c.reached WHERE g.form IS NOT NULL)
SELECT g.word, n, n_near, form, form_n, coalesce(l.root, g.word) AS root FROM g LEFT JOIN (SELECT word, arg_max(reached, step) AS root FROM c GROUP BY word) l ON l.word = g.word"""
