"""SimHash fingerprints of word shingles and their near-duplicate groups.

Two fingerprints link when they differ in few bits. All linked pairs are found by a
self-join of the binary trie of fingerprints: pairs of nodes go down together, add up the
bits in which their paths differ, and end when the error budget is used up. The upper part
of the walk is a table of node pairs that Spark extends four bits at a time; a pair whose
nodes hold few fingerprints becomes one piece of work, in which numpy finishes the walk. A
crowded node is split further, so no piece grows with the data or with a group of copies.

Definitions for odd input: a null text has no words; without words the fingerprint is
zero and links like any other; with fewer words than a shingle the whole sequence is the
only shingle. Rows with a null doc_id take part, and give a null component only where no
member has an id. Repeated rows are copies of each other. An empty table gives an empty
result. Columns other than doc_id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placetime.llm.common import every, free_name
from placetime.llm.components import components
from placetime.session import checkpointed

SEED = 42
SHINGLE = 3
BUDGET = 2
STEP = 4  # bits that node pairs go down at a time
LEAF = 32_768  # fingerprints of a pair of nodes that one piece of work may hold
BLOCK = 65_536  # shingles of a text that are counted at a time
FRONTIER = 1 << 18  # node pairs that numpy extends at a time


def simhash(text: str | None, size: int = SHINGLE) -> int:
    """Fingerprint as a signed 64-bit number; a bit is set if it is set in over half the hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = [len(w) for w in words]
    starts = list(accumulate((n + 1 for n in lengths[:-1]), initial=0))
    size = min(size, len(words))
    ends = [a + n for a, n in zip(starts[size - 1:], lengths[size - 1:], strict=True)]
    digest, total = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(ends), BLOCK):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + BLOCK], ends[at:at + BLOCK], strict=False)])
        total += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(ends)).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def _simhash(texts: pd.Series) -> pd.Series:
    return pd.Series([simhash(t) for t in texts], dtype="int64")


def fingerprint(text: Column | str) -> Column:
    """Fingerprint of a text column as a 64-bit number."""
    return _simhash(text)


def as_hex(fp: Column | str) -> Column:
    """Sixteen lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _node(fp: str, depth: int) -> Column:
    return F.shiftrightunsigned(fp, 64 - depth)


def _leaf_pairs(fps: DataFrame, budget: int, leaf: int) -> tuple[DataFrame, list[int]]:
    """Node pairs (a, b, depth, used) with few fingerprints, and the depths that occur.

    Every pair of fingerprints within the budget lies under exactly one of them.
    """
    found = fps.sparkSession.createDataFrame([], "a long, b long, used int, depth int")
    pairs, depth, depths = None, 0, []
    while True:
        deeper = depth + STEP
        children = fps.select(_node("fp", deeper).alias("node")).groupBy("node").agg(F.count("*").alias("n"))
        if pairs is None:
            started = children.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("used"), F.lit(True).alias("same"))
        else:
            started = pairs.select("a", "b", "used", (F.col("a") == F.col("b")).alias("same")).join(
                children.select(F.shiftrightunsigned("node", STEP).alias("a"), F.col("node").alias("x"), F.col("n").alias("nx")), "a")
        # from a node below a, the nodes below b that lie within the budget
        masks = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(m.bit_count()).alias("d")) for m in range(1 << STEP) if m.bit_count() <= budget])
        low = F.col("x").bitwiseAND(F.lit((1 << STEP) - 1))
        wanted = (
            started.withColumn("mask", F.explode(masks)).withColumn("used", F.col("used") + F.col("mask.d")).where(F.col("used") <= budget)
            .withColumn("y", F.shiftleft("b", STEP).bitwiseOR(low.bitwiseXOR(F.col("mask.m")))).where(~F.col("same") | (F.col("x") <= F.col("y")))
        )
        pairs = checkpointed(
            wanted.join(children.select(F.col("node").alias("y"), F.col("n").alias("ny")), "y")
            .select(F.col("x").alias("a"), F.col("y").alias("b"), "used", F.col("nx").alias("na"), F.col("ny").alias("nb"))
        )
        depth = deeper
        own = F.when(F.col("a") == F.col("b"), F.col("na")).otherwise(F.col("na") + F.col("nb"))
        crowd = (own > leaf) if depth < 64 else F.lit(False)
        small, large = pairs.where(~crowd), pairs.where(crowd)
        if small.limit(1).count():
            found, depths = found.union(small.select("a", "b", "used", F.lit(depth).alias("depth"))), [*depths, depth]
        if not large.limit(1).count():
            return found, depths
        pairs = large


def _walk(left: np.ndarray, right: np.ndarray, same: bool, depth: int, used: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two sorted fingerprint arrays that differ in at most ``budget`` bits.

    The arrays lie under two trie nodes of the given depth, which differ in ``used`` bits.
    With ``same`` the arrays are one and each pair comes once.
    """
    def ones(values: np.ndarray, bit: int) -> np.ndarray:
        return np.concatenate(([0], np.cumsum((values >> np.uint64(63 - bit)) & np.uint64(1), dtype=np.int64)))

    start = np.array([[0, len(left), 0, len(right), used]], np.int64)
    stack = [(depth, start)]
    while stack:
        at, nodes = stack.pop()
        few = ((nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2]) <= 16) | (at == 64)
        if few.any():
            i, j = _product(nodes[few])
            if same:
                i, j = i[i < j], j[i < j]
            near = np.bitwise_count(left[i] ^ right[j]) <= budget
            yield i[near], j[near]
        nodes = nodes[~few]
        if not len(nodes):
            continue
        la, lb, ra, rb, spent = nodes.T
        count_l, count_r = ones(left, at), ones(right, at)
        lm = lb - (count_l[lb] - count_l[la])
        rm = rb - (count_r[rb] - count_r[ra])
        twin = (la == ra) & (lb == rb) if same else np.zeros(len(la), bool)
        made = np.concatenate([
            np.stack([la, lm, ra, rm, spent], 1), np.stack([lm, lb, rm, rb, spent], 1),
            np.stack([la, lm, rm, rb, spent + 1], 1), np.stack([lm, lb, ra, rm, spent + 1], 1)[~twin],
        ])
        made = made[(made[:, 0] < made[:, 1]) & (made[:, 2] < made[:, 3]) & (made[:, 4] <= budget)]
        stack += [(at + 1, made[k:k + FRONTIER]) for k in range(0, len(made), FRONTIER)]


def _product(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs of small node pairs."""
    wide = nodes[:, 3] - nodes[:, 2]
    size = (nodes[:, 1] - nodes[:, 0]) * wide
    which = np.repeat(np.arange(len(nodes)), size)
    k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return nodes[which, 0] + k // wide[which], nodes[which, 2] + k % wide[which]


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least index of each of n nodes' group, groups joined by the pairs."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            low, high = np.minimum(a, b), np.maximum(a, b)
            open_ = low < high
            if not open_.any():
                break
            np.minimum.at(root, high[open_], low[open_])
            while (root != root[root]).any():
                root = root[root]
    return root


def _links(budget: int):
    def work(key: tuple, rows: pa.Table) -> pa.Table:
        a, b, depth, used = (k.as_py() for k in key)
        values = rows["fp"].to_numpy().view(np.uint64)
        if a == b:
            every = np.sort(values)
            root = _forest(len(every), _walk(every, every, True, depth, used, budget))
        else:
            side = rows["right"].to_numpy(zero_copy_only=False).astype(bool)
            left, right = np.sort(values[~side]), np.sort(values[side])
            every = np.concatenate([left, right])
            root = _forest(len(every), ((i, j + len(left)) for i, j in _walk(left, right, False, depth, used, budget)))
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"u": every[linked].view(np.int64), "v": every[root[linked]].view(np.int64)})
    return work


def links(fps: DataFrame, budget: int = BUDGET, leaf: int = LEAF) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints which chains of links connect.

    ``fps`` has one row per distinct fingerprint in column fp. Each piece of work gives a
    spanning forest, never all of its pairs.
    """
    pairs, depths = _leaf_pairs(fps, budget, leaf)
    dealt = None
    for depth in depths:
        here = pairs.where(F.col("depth") == depth)
        keyed = fps.select("fp", _node("fp", depth).alias("node"))
        lefts = keyed.join(here.withColumnRenamed("a", "node"), "node").select(F.col("node").alias("a"), "b", "depth", "used", "fp", F.lit(False).alias("right"))
        rights = keyed.join(here.where("a <> b").withColumnRenamed("b", "node"), "node").select("a", F.col("node").alias("b"), "depth", "used", "fp", F.lit(True).alias("right"))
        both = lefts.union(rights)
        dealt = both if dealt is None else dealt.union(both)
    if dealt is None:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    return dealt.groupBy("a", "b", "depth", "used").applyInArrow(_links(budget), "u long, v long")


def groups(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(doc_id, fp, component_id) for every row; the component is the least doc_id reachable by links."""
    return grouped(checkpointed(docs.select("doc_id", fingerprint("text").alias("fp"))), budget)


def grouped(marked: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Adds component_id to rows that have doc_id and fp; ``marked`` is read several times."""
    fps = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("least_doc")))
    roots = components(links(fps.select("fp"), budget))
    rooted = (
        fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "least_doc", F.coalesce("root", "fp").alias("root"))
    )
    named = rooted.join(rooted.groupBy("root").agg(F.min("least_doc").alias("component_id")), "root").select("fp", "component_id")
    return marked.join(named, "fp")


def deduplicated(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """One document of each group: the one with the least doc_id, all columns unchanged.

    Rows that repeat a doc_id count as one document: of those the row with the least content
    hash stays. A group without any doc_id keeps one row of each fingerprint, chosen alike.
    """
    mark = F.xxhash64(*every(docs))
    marked = checkpointed(docs.select("doc_id", mark.alias("content"), fingerprint("text").alias("fp")))
    best = (
        grouped(marked, budget).where(F.col("component_id").eqNullSafe(F.col("doc_id")))
        .groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("alone"))
        .agg(F.min("content").alias("content")).select("content")
    )
    copies = marked.groupBy("content").agg((F.count("*") > 1).alias("repeated"))
    keys = checkpointed(copies.join(best, "content", "left_semi"))
    name = free_name(docs, "content")
    hashed = docs.select(*every(docs), mark.alias(name))

    def chosen(repeated: bool) -> DataFrame:
        wanted = keys.where(F.col("repeated") == repeated)
        return hashed.join(wanted, hashed[name] == wanted["content"], "left_semi")

    return chosen(False).union(chosen(True).dropDuplicates([name])).select(*every(docs))
