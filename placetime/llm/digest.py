"""Digests of improbable features, and their likeness.

Every window of 64 bytes of a text has an entropy. How often each entropy occurs in all
windows of all documents says how rare it is, and the rarest window of its neighbourhood (32
places to either side, the first of equals) is a feature. Features go, in order, into a
chain of Bloom filters of 2048 bits with five bits for each of at most 160 features. Two
filters are as alike as the bits they share beyond what chance would give, relative to the
most they could share; two chains as the mean, over the shorter one's filters, of the best
match in the other, weighted by bits.

Entropies are sums of whole numbers, so a text has the same digest wherever it stands. The
table of rarities has about a thousand rows.

The next document in ascending doc_id is found without one global order: ids are cut in
ranges of about equal numbers of rows, and the first document of a range is also sent to the
range before it. A range is sorted within one task and read as a stream.

Definitions for odd input: a null text is an empty one. A text shorter than a window has one
feature, itself; an empty one has none and an empty digest. Two empty digests are alike
(1), an empty one and another are not (0). Rows that repeat a doc_id follow each other in the
order of their texts. A row without a doc_id has no next document: its last quarter is
removed and its likeness to the next is 0. The only row of a table is its own next. An empty
table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 64
NEAR = 32
BINS = 1024
BITS = 2048
HASHES = 5
PER_FILTER = 160
CHUNK = 1 << 20  # bytes of text that numpy works on at a time
FAR = np.int32(1 << 30)

#: change of the sum of c * log2(c), in units of 2**-20, when a byte's count in the window becomes c
_STEP = np.concatenate(([0], np.diff(np.round([0.0] + [c * np.log2(c) * (1 << 20) for c in range(1, WINDOW + 1)]).astype(np.int64))))


def entropies(data: np.ndarray) -> np.ndarray:
    """Bin (0 to BINS - 1) of the entropy of every window of a byte array.

    A window follows from the one before it by the byte that leaves and the byte that comes;
    how often these occur in their windows is found in the list of places of each byte.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    order = np.argsort(data, kind="stable")
    key = data[order].astype(np.int64) * (2 * len(data) + 2 * WINDOW) + order
    place = np.arange(len(data))
    ahead, behind = np.empty(len(data), np.int64), np.empty(len(data), np.int64)
    ahead[order] = np.searchsorted(key, key + WINDOW) - place  # in the window that starts here
    behind[order] = place - np.searchsorted(key, key - WINDOW + 1) + 1  # in the window that ends here
    came = np.zeros(n, np.int64)
    came[0] = _STEP[_counted(data[:WINDOW])].sum()
    came[1:] = _STEP[behind[WINDOW:]] - _STEP[ahead[:n - 1]]
    total = np.cumsum(came)
    return ((WINDOW * 6 * (1 << 20) - total) * (BINS - 1) // (WINDOW * 6 * (1 << 20))).astype(np.int32)


def _counted(data: np.ndarray) -> np.ndarray:
    """For each byte how often it has occurred so far."""
    return np.array([np.count_nonzero(data[:i + 1] == b) for i, b in enumerate(data)])


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, where each text starts, and which windows lie within one text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else sizes
    inside = np.ones(max(len(data) - WINDOW + 1, 0), bool)
    for s, n in zip(starts.tolist(), sizes.tolist(), strict=True):
        inside[max(s + n - WINDOW + 1, s, 0):s + n] = False
    return data, starts, inside


def histogram(texts: list[bytes]) -> np.ndarray:
    """How often each entropy occurs in the windows of the texts."""
    data, _, inside = _joined(texts)
    return np.bincount(entropies(data)[inside], minlength=BINS)


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy, the rarest first."""
    out = np.empty(BINS, np.int32)
    out[np.lexsort((np.arange(BINS), counts))] = np.arange(BINS, dtype=np.int32)
    return out


def _lowest(values: np.ndarray, span: int) -> np.ndarray:
    """Least of each ``span`` values in a row (a power of two), by doubling."""
    step = 1
    while step < span:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return values


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashes(windows: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of 64 bytes."""
    out = np.full(len(windows), 0x9E3779B97F4A7C15, np.uint64)
    for word in np.ascontiguousarray(windows).view("<u8").T:
        out = _mix(out ^ word)
    return out


def features(texts: list[bytes], rank: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and hashes of the features of each text."""
    data, starts, inside = _joined(texts)
    places, marks = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(inside):
        r = np.where(inside, rank[entropies(data)], FAR)
        padded = np.concatenate((np.full(NEAR, FAR), r, np.full(NEAR, FAR)))
        low = _lowest(padded, NEAR)  # low[i]: of padded[i:i + NEAR]
        places = np.flatnonzero((r < FAR) & (r < low[:len(r)]) & (r <= low[NEAR + 1:NEAR + 1 + len(r)]))
        marks = _hashes(np.lib.stride_tricks.sliding_window_view(data, WINDOW)[places])
    cuts = np.searchsorted(places, np.append(starts, len(data)))
    out = []
    for i, text in enumerate(texts):
        if 0 < len(text) < WINDOW:
            short = np.frombuffer(text.ljust(WINDOW, b"\0"), np.uint8)[None]
            out.append((np.zeros(1, np.int64), _mix(_hashes(short) ^ np.uint64(len(text)))))
        else:
            out.append((places[cuts[i]:cuts[i + 1]] - starts[i], marks[cuts[i]:cuts[i + 1]]))
    return out


def chain(marks: np.ndarray) -> np.ndarray:
    """Bloom filters of the features in order: an array of rows of BITS / 8 bytes."""
    filters = -(-len(marks) // PER_FILTER)
    bits = np.zeros((filters, BITS), bool)
    which = np.arange(len(marks)) // PER_FILTER
    for k in range(HASHES):
        bits[which, (marks >> np.uint64(11 * k)).astype(np.int64) % BITS] = True
    return np.packbits(bits, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness of two chains from 0 to 1."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return float(not len(b))
    ones_b = np.bitwise_count(b).sum(1, dtype=np.int64)
    total, weight = 0.0, 0
    for row in a:
        own = int(np.bitwise_count(row).sum())
        shared = np.bitwise_count(b & row).sum(1, dtype=np.int64)
        chance, most = own * ones_b / BITS, np.minimum(own, ones_b)
        total += own * float(np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1).max())
        weight += own
    return total / weight


def edited(text: str, following: str) -> tuple[str, int]:
    """The text with its last quarter replaced from the next text, and the characters that stay."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k], len(text) - k


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def digests(rows: list[tuple[str, str]], rank: np.ndarray) -> Iterator[tuple[int, str, str, str, float, float]]:
    """For pairs of a text and the next one: n_chars, edited_sha256, both digests and both likenesses.

    The edited text shares its first part with the text; only features that the change can
    reach are looked for again.
    """
    texts = [_bytes(t) for t, _ in rows]
    changed = [edited(t, f) for t, f in rows]
    whole = [_bytes(e) for e, _ in changed]
    kept = [len(_bytes(t[:k])) for (t, _), (_, k) in zip(rows, changed, strict=True)]
    safe = [max(0, k - WINDOW - NEAR) for k in kept]  # features before it are those of the text
    base = [max(0, s - NEAR - 1) for s in safe]
    own = features(texts, rank)
    tails = features([w[b:] for w, b in zip(whole, base, strict=True)], rank)
    apart = [i for i, (_, f) in enumerate(rows) if i + 1 == len(rows) or rows[i + 1][0] != f]
    lone = dict(zip(apart, features([_bytes(rows[i][1]) for i in apart], rank), strict=True))
    following = [lone.get(i) or own[i + 1] for i in range(len(rows))]
    for (text, _), w, s, b, (at, marks), (at_tail, marks_tail), (_, next_marks) in zip(rows, whole, safe, base, own, tails, following, strict=True):
        both = np.concatenate((marks[at < s], marks_tail[at_tail + b >= s]))
        c, e, n = chain(marks), chain(both), chain(next_marks)
        yield len(text), hashlib.sha256(w).hexdigest(), c.tobytes().hex(), e.tobytes().hex(), likeness(c, e), likeness(c, n)


def rarities(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy over the windows of all texts: BINS numbers."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(BINS, np.int64), [], 0
        for b in batches:
            for t in b.column(0).to_pylist():
                held.append(_bytes(t or ""))
                size += len(held[-1])
                if size > CHUNK:
                    total += histogram(held)
                    held, size = [], 0
        total += histogram(held)
        yield pa.RecordBatch.from_pydict({"bin": pa.array(np.arange(BINS)), "n": pa.array(total)})

    counted = docs.select("text").mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    out = np.zeros(BINS, np.int64)
    for r in counted.collect():
        out[r.bin] = r.n
    return ranks(out)


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds lie below a value, by halving."""
    array, size = F.lit(bounds) if bounds else F.array().cast("array<long>"), len(bounds)

    def half(a: Column, _: Column) -> Column:
        middle = F.floor((a["low"] + a["high"]) / 2).cast("int")
        below = F.get(array, middle) < value
        return F.when(a["low"] >= a["high"], a).when(below, F.struct((middle + 1).alias("low"), a["high"].alias("high"))).otherwise(F.struct(a["low"].alias("low"), middle.alias("high")))

    start = F.struct(F.lit(0).alias("low"), F.lit(size).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(size.bit_length() + 1)), start, half)["low"]


def in_order(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, text, range and after: documents dealt by range of doc_id and sorted in each.

    A range ends with a copy of the first document of the next range that has any (the last
    with that of the first), marked by ``after``. Rows without a doc_id have no next one; they are
    dealt by their texts to ranges below 0.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id").where("doc_id is not null")
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0]
    bounds = sorted(set(cuts or []))
    alone = (-1 - F.pmod(F.xxhash64("text"), F.lit(ranges))).cast("int")
    own = _range_of(F.col("doc_id"), bounds)
    part = F.when(F.col("doc_id").isNull(), alone).otherwise(own)
    heads = {r[0]: r[1] for r in ids.groupBy(own.alias("range")).agg(F.min("doc_id")).collect()}
    full = sorted(heads)
    before = [(heads[r], full[i - 1]) for i, r in enumerate(full)]
    copied = docs.join(F.broadcast(spark.createDataFrame(before, "doc_id long, range int")), "doc_id").select("doc_id", "text", "range", F.lit(True).alias("after"))
    dealt = docs.select("doc_id", "text", part.alias("range"), F.lit(False).alias("after")).union(copied)
    return dealt.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "after", "doc_id", "text")


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """Digest of every text and of its edited form, and their likenesses, for every row of ``docs``."""
    rank = rarities(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        pairs: list[tuple[str, str]] = []

        def out() -> pa.RecordBatch:
            made = list(digests(pairs, rank))
            columns = list(zip(*made, strict=True))
            if None in ids:
                columns[5] = tuple(0.0 if i is None else v for i, v in zip(ids, columns[5], strict=True))
            names = [c.split(" ")[0] for c in RESULT.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([ids, *columns], kinds, strict=True)], names=names)

        last, size = None, 0
        for b in batches:
            for doc_id, text, part, after in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if last is not None:
                    ids.append(last[0])
                    pairs.append((last[1], text if last[2] == part >= 0 else ""))
                    size += 2 * len(last[1])
                last = None if after else (doc_id, text, part)
                if size > CHUNK:
                    yield out()
                    ids, pairs, size = [], [], 0
        if last is not None:
            ids.append(last[0])
            pairs.append((last[1], ""))
        if pairs:
            yield out()

    return in_order(docs).mapInArrow(work, RESULT)
