"""Shards of near equal bytes by a k-d tree over what is known of the documents.

Every document is a point: one number per dimension, from the first six bytes of a string or the
logarithm of a number, dealt to ``BINS`` equal steps between the least and the largest. A node
of the tree that stands for k shards is cut in two along its widest dimension, the one on which its
documents lie the most steps apart, where the bytes before the cut are to the bytes behind it as the shards
before it to those behind it: the weighted median, if k is even. The median comes from two
histograms of bytes that merge like any sum. The first, over the steps of all dimensions, gives the
widest dimension and the step that the cut falls in; the second, over ``TIES`` parts of a hash, says
which documents of this step go to which side, so a step may hold any share of all documents. All
nodes of a level are cut together and the number of levels is the logarithm of the number of shards.

The cuts are one row per node, fewer than there are shards: these rows alone are broadcast. Documents
are never moved while the tree grows; a document finds its shard by joining the cuts of each
level. Slots are numbered in chunks of a shard's documents: a chunk's first number is the sum of the counts
of the chunks before it.

Definitions for odd input: a null text has no bytes. Null values of a dimension lie before all
others. Rows with equal doc_id and text are one point and go to one shard, so a shard can be as much
larger than the others as one such row's copies have bytes; rows that share the text alone can be
parted. An empty table gives an empty result. Columns that are not named play no part;
``with_shard`` keeps them, whatever their names.

DataFrame functions only.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placetime.llm.common import every, free_name, quoted
from placetime.session import checkpointed

SHARDS = 24
DIMENSIONS = ("lang", "source", "n_chars")
EXTRA = 8  # bytes of a document besides its text
BINS = 1024  # steps of a dimension
TIES = 14  # bits of the hash that order the documents of one step
CHUNK = 4096  # documents of a shard that are numbered together, about


class Tree(NamedTuple):
    """Least and largest value of each dimension, the cuts of each level, and the number of documents."""

    ranges: list[tuple[float, float]]
    levels: list[DataFrame]
    rows: int


def position(value: Column, kind: T.DataType) -> Column:
    """A number that follows the order of a string's first bytes, or of a number."""
    if isinstance(kind, T.NumericType):
        value = value.cast("double")
        return F.signum(value) * F.log1p(F.abs(value))
    start = F.hex(F.substring(value.cast("string").cast("binary"), 1, 6))
    return F.conv(F.rpad(start, 12, "0"), 16, 10).cast("double")


def marks(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS) -> Column:
    """Struct of size, text_crc32, the hash that breaks ties, and the position in every dimension."""
    text = F.coalesce(docs["text"], F.lit(""))
    crc = F.crc32(text.cast("binary"))
    tie = F.xxhash64(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit(":"), crc.cast("string")))
    positions = F.array(*[position(docs[quoted(d)], docs.schema[d].dataType) for d in dimensions])
    return F.struct((F.octet_length(text) + EXTRA).cast("long").alias("size"), crc.alias("text_crc32"), tie.alias("tie"), positions.alias("at"))


def steps(at: Column, ranges: list[tuple[float, float]]) -> Column:
    """The step of each position: 0 for null, else 1 and more."""
    def step(k: int, low: float, high: float) -> Column:
        scale = (BINS - 2) / (high - low) if high > low else 0.0
        return F.when(at[k].isNull(), 0).otherwise(F.floor((at[k] - low) * scale) + 1).cast("int")
    return F.array(*[step(k, *r) for k, r in enumerate(ranges)])


def _descended(rows: DataFrame, levels: list[DataFrame], mark: str, shard: str) -> DataFrame:
    """Adds the node that every row has reached, by its struct ``mark`` of tie and steps."""
    rows = rows.withColumn(shard, F.lit(0))
    for cuts in levels:
        own = cuts.select(F.struct(*cuts.columns).alias(cut := free_name(rows, "cut")))
        rows = rows.join(F.broadcast(own), F.col(shard) == F.col(cut)["node"], "left")
        step = F.get(F.col(mark)["steps"], F.col(cut)["dimension"])
        after = (step > F.col(cut)["step"]) | ((step == F.col(cut)["step"]) & (_part(F.col(mark)["tie"]) >= F.col(cut)["part"]))
        rows = rows.withColumn(shard, F.when(after, F.col(shard) + F.col(cut)["before"]).otherwise(F.col(shard))).drop(cut)
    return rows


def _part(tie: Column) -> Column:
    return F.shiftrightunsigned(tie, 64 - TIES)


def _cuts(rows: DataFrame, nodes: list[tuple[int, int]]) -> DataFrame:
    """(node, before, dimension, step, part) of every node (first shard, shards): where its rows are cut."""
    plan = rows.sparkSession.createDataFrame([(n, k, k // 2) for n, k in nodes], "node int, shards int, before int")
    here = rows.join(F.broadcast(plan.select("node")), "node")
    bytes_of = checkpointed(
        here.select("node", "size", F.posexplode("m.steps").alias("dimension", "step"))
        .groupBy("node", "dimension", "step").agg(F.sum("size").alias("size"))
    )
    spread = bytes_of.groupBy("node", "dimension").agg((F.max("step") - F.min("step")).alias("wide"), F.sum("size").alias("total"))
    # least of (-wide, dimension): the widest, of equal ones the first
    widest = spread.groupBy("node").agg(F.min(F.struct((-F.col("wide")).alias("wide"), "dimension")).alias("w"), F.max("total").alias("total"))
    aims = plan.join(widest.select("node", "w.dimension", "total"), "node").withColumn("aim", F.col("total") * F.col("before") / F.col("shards"))
    upto = W.partitionBy("node").orderBy("step")
    ranked = bytes_of.join(aims, ["node", "dimension"]).withColumn("upto", F.sum("size").over(upto))
    # the first step that reaches the aim, and the bytes that are missing before it
    crossed = ranked.where("upto >= aim").groupBy("node", "before", "dimension").agg(F.min(F.struct("step", (F.col("aim") - F.col("upto") + F.col("size")).alias("need"))).alias("c"))
    crossed = checkpointed(crossed.select("node", "before", "dimension", "c.step", "c.need"))
    inside = rows.join(F.broadcast(crossed), "node").where(F.get("m.steps", F.col("dimension")) == F.col("step"))
    parts = inside.groupBy("node", "before", "dimension", "step", "need", _part(F.col("m.tie")).alias("part")).agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(W.partitionBy("node").orderBy("part"))
    ends = parts.withColumn("upto", upto).select("node", "before", "dimension", "step", (F.col("part") + 1).alias("part"), F.abs(F.col("upto") - F.col("need")).alias("off"))
    none = crossed.select("node", "before", "dimension", "step", F.lit(0).cast("long").alias("part"), F.col("need").alias("off"))
    best = ends.union(none).groupBy("node", "before", "dimension", "step").agg(F.min(F.struct("off", "part")).alias("best"))
    return checkpointed(best.select("node", "before", "dimension", "step", F.col("best.part").cast("long").alias("part")))


def grown(marked: DataFrame, dimensions: int, shards: int = SHARDS, target_bytes: int | None = None) -> Tree:
    """The tree over a table with the struct ``m`` of ``marks`` in so many dimensions.

    With ``target_bytes`` there are as many shards as leaves of that size make. The driver sees
    one row of totals; which nodes there are follows from the number of shards alone.
    """
    ends = [f(F.col("m.at")[k]) for k in range(dimensions) for f in (F.min, F.max)]
    rows, total, *ends = marked.agg(F.count("*"), F.sum("m.size"), *ends).first()
    ranges = [(low or 0.0, high or 0.0) for low, high in zip(ends[::2], ends[1::2], strict=True)]
    if target_bytes is not None:
        shards = max(1, math.ceil((total or 0) / target_bytes))
    levels, nodes = [], [(0, shards)] if rows else []
    while nodes := [(n, k) for n, k in nodes if k > 1]:
        here = _descended(marked.select(F.col("m.size").alias("size"), _mark(ranges).alias("m")), levels, "m", "node")
        levels.append(_cuts(here, nodes))
        nodes = [half for n, k in nodes for half in ((n, k // 2), (n + k // 2, k - k // 2))]
    return Tree(ranges, levels, rows)


def _mark(ranges: list[tuple[float, float]]) -> Column:
    return F.struct(F.col("m.tie").alias("tie"), steps(F.col("m.at"), ranges).alias("steps"))


def with_shard(docs: DataFrame, shards: int = SHARDS, target_bytes: int | None = None, dimensions: tuple[str, ...] = DIMENSIONS, name: str = "shard") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, with their shard in column ``name``: ready to be written by shard."""
    plan = grown(checkpointed(docs.select(marks(docs, dimensions).alias("m"))), len(dimensions), shards, target_bytes)
    mark, shard = free_name(docs, "mark"), free_name(docs, "node")
    own = F.struct(F.col(mark)["tie"].alias("tie"), steps(F.col(mark)["at"], plan.ranges).alias("steps"))
    rows = docs.select(*every(docs), marks(docs, dimensions).alias(mark)).withColumn(mark, own)
    return _descended(rows, plan.levels, mark, shard).select(*every(docs), F.col(shard).alias(name))


def placed(docs: DataFrame, shards: int = SHARDS, target_bytes: int | None = None, dimensions: tuple[str, ...] = DIMENSIONS, chunk: int = CHUNK) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs``; slots count from 0 in each shard."""
    marked = checkpointed(docs.select("doc_id", marks(docs, dimensions).alias("m")))
    plan = grown(marked, len(dimensions), shards, target_bytes)
    chunks = max(0, math.ceil(math.log2(max(1, plan.rows / shards / chunk))))
    rows = marked.select("doc_id", F.col("m.size").alias("size"), F.col("m.text_crc32").alias("text_crc32"), _mark(plan.ranges).alias("m"))
    part = F.shiftrightunsigned("m.tie", 64 - chunks) if chunks else F.lit(0).cast("long")
    rows = checkpointed(_descended(rows, plan.levels, "m", "shard").select("doc_id", "size", "text_crc32", "shard", part.alias("chunk"), F.col("m.tie").alias("tie")))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("chunk")) - F.col("n")
    first = rows.groupBy("shard", "chunk").agg(F.count("*").alias("n")).select("shard", "chunk", before.alias("first"))
    place = F.row_number().over(W.partitionBy("shard", "chunk").orderBy("tie", "doc_id", "text_crc32", "size")) - 1
    numbered = rows.withColumn("place", place).join(first, ["shard", "chunk"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place")).cast("long").alias("slot"))
