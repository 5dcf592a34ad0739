"""Batches of ranked text queries over a document table.

Scoring. A field matches a query when it contains the query, ignoring case, with at
most ``floor(0.1 * length)`` edits (none in exact mode); its position does not count.
The score of a document is ``sum(weight * (1 - edits / length)) / sum(weight)`` over
its fields, where a field without a match adds nothing. It lies in (0, 1]; higher is
better, ties go to the lower document id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placetime.functions import text
from placetime.session import checkpointed

# Field weights, tolerance and list lengths that results depend on.
WEIGHTS = {"title": 20, "section": 20, "text": 10}
THRESHOLD = 0.1
RESULT_LIMIT = 50
COLLAPSE_AFTER = 3
QUERY_PARAMETER = "q"

RUN = 8  # bytes of the longest run
RUNS = 4  # runs of a query without edits
AROUND = 48  # bytes before and after a run that are looked at if there can be edits
TILE = 3  # bytes
_SHIFT = 4  # bytes of the longest character
SLOT_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BYTES_AT_ONCE = 1 << 17
_QUERIES_AT_ONCE = 1000
_VERIFY_AT_ONCE = 200_000


def _edit_distance(windows: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """Fewest edits between each pattern and any part of its window, row by row."""
    rows, length = patterns.shape
    best = np.full(rows, length, dtype=np.int16)
    column = np.repeat(np.arange(length + 1, dtype=np.int16)[:, None], rows, axis=1)
    for j in range(windows.shape[1]):
        diagonal = column[0].copy()
        for i in range(1, length + 1):
            substituted = diagonal + (patterns[:, i - 1] != windows[:, j])
            diagonal = column[i].copy()
            column[i] = np.minimum(np.minimum(column[i - 1], column[i]) + 1, substituted)
        np.minimum(best, column[length], out=best)
    return best


def _cuts(length: int, edits: int) -> list[int]:
    """Bounds of the pieces of a query: with k edits at least one of k + 1 is found unchanged."""
    return [length * i // (edits + 1) for i in range(edits + 2)]


def _fewest_edits(texts: list[str | None], queries: list[str], threshold: float) -> list[int | None]:
    """Fewest edits between each query and any part of its text; None beyond the tolerance."""
    found: list[int | None] = [None] * len(texts)
    open_: dict[str, list[tuple[int, int]]] = {}
    for row, (value, query) in enumerate(zip(texts, queries, strict=True)):
        edits = int(threshold * len(query) + 1e-9)
        if not value:
            continue
        if query in value:
            found[row] = 0
        elif edits:
            cuts, spots = _cuts(len(query), edits), set()
            for start, stop in zip(cuts, cuts[1:], strict=False):
                at = value.find(query[start:stop])
                while at >= 0:
                    spots.add(at - start)
                    at = value.find(query[start:stop], at + 1)
            waiting = open_.setdefault(query, [])
            waiting += [(row, at) for at in spots]
            if len(waiting) >= _VERIFY_AT_ONCE:
                _verify(query, edits, open_.pop(query), texts, found)
    for query, spots in open_.items():
        _verify(query, int(threshold * len(query) + 1e-9), spots, texts, found)
    return found


def _verify(query: str, edits: int, spots: list[tuple[int, int]], texts: list, found: list) -> None:
    """Compare a query with the stretches of texts around spots, many at a time."""
    pattern = np.frombuffer(query.encode("utf-32-le"), dtype=np.uint32)
    width = len(query) + 2 * edits
    for k in range(0, len(spots), _VERIFY_AT_ONCE):
        some = spots[k:k + _VERIFY_AT_ONCE]
        windows = np.zeros((len(some), width), dtype=np.uint32)
        for row, (t, at) in enumerate(some):
            lo = at - edits
            codes = np.frombuffer(texts[t][max(lo, 0):max(lo + width, 0)].encode("utf-32-le"), dtype=np.uint32)
            begin = max(-lo, 0)
            windows[row, begin:begin + len(codes)] = codes
        patterns = np.broadcast_to(pattern, (len(some), len(query)))
        for (t, _), distance in zip(some, _edit_distance(windows, patterns), strict=True):
            if distance <= edits and (found[t] is None or distance < found[t]):
                found[t] = int(distance)


def _slots(runs: np.ndarray, width: int) -> np.ndarray:
    """Places of runs of bytes in the filter."""
    return ((runs + np.uint64(width)) * _MIX) >> np.uint64(64 - SLOT_BITS)


def _query_runs(query: str, threshold: float) -> Iterator[tuple]:
    """(part, run, width, slot, runs of the part, edits, near, at): runs of bytes of each piece of a query.

    Without edits the one piece has a few runs spread over it. With edits each piece has its
    first run, and ``near`` is what stands around it, from byte ``at`` before the run.
    """
    edits, whole = int(threshold * len(query) + 1e-9), query.encode()
    cuts = _cuts(len(query), edits)
    for part, (start, stop) in enumerate(zip(cuts, cuts[1:], strict=False)):
        piece, before = query[start:stop].encode(), len(query[:start].encode())
        width = min(RUN, len(piece))
        last = len(piece) - width
        spread = {0} if edits else {last * i // (RUNS - 1) for i in range(RUNS)}
        runs = sorted({int.from_bytes(piece[at:at + width], "little") for at in spread})
        reach = max(0, AROUND - _SHIFT * edits)
        near = whole[max(0, before - reach):before + width + reach] if edits else None
        for run, place in zip(runs, _slots(np.array(runs, np.uint64), width), strict=True):
            yield part, int(np.uint64(run).view(np.int64)), width, int(place), len(runs), edits, near, min(before, reach)


_RUN_FIELDS = {"part": pa.int64(), "run": pa.int64(), "width": pa.int64(), "slot": pa.int64(), "needed": pa.int64(), "edits": pa.int64(), "near": pa.binary(), "at": pa.int64()}


def _asked_runs(threshold: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for i, query in enumerate(batch["query"].to_pylist()):
                own = list(_query_runs(query, threshold))
                ids += [i] * len(own)
                rows += own
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(_RUN_FIELDS.values())]
            yield pa.RecordBatch.from_arrays([batch["query_id"].take(pa.array(ids, pa.int64())), *columns], names=["query_id", *_RUN_FIELDS])
    return work


def _held_runs(exact: bytes, loose: bytes, widths: list[int]):
    """Which of the runs that queries use, as far as the filters tell, each text holds.

    Runs of queries without edits come once per text; others each time they occur, with the bytes around.
    """
    masks = [(w, np.uint64((1 << 8 * w) - 1)) for w in widths]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # bit 0: queries without edits use the run, bit 1: others do
        wanted = sum(np.unpackbits(np.frombuffer(f, np.uint8), bitorder="little") << k for k, f in enumerate((exact, loose)))
        names = ["doc_id", "run", "width", "context", "lead"]
        for batch in batches:
            texts = batch["text"]
            _, offsets, data = texts.buffers()
            offsets = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
            data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            for begin in range(int(offsets[0]), int(offsets[-1]), _BYTES_AT_ONCE):
                stop = min(begin + _BYTES_AT_ONCE, int(offsets[-1]))
                runs = np.zeros(stop - begin + RUN, np.uint64)
                own = data[begin:min(stop + RUN - 1, int(offsets[-1]))]
                runs[:len(own)] = own
                for k in (1, 2, 4):  # pairs, fours, eights of bytes
                    runs = runs[:-k] | runs[k:] << np.uint64(8 * k)
                runs = runs[:stop - begin]
                for width, mask in masks:
                    some = runs & mask
                    marks = wanted[_slots(some, width)]
                    found_at = np.flatnonzero(marks)
                    marks = marks[found_at]
                    for kind in (1, 2):
                        hit = found_at[marks & kind > 0]
                        place = hit + begin
                        doc = np.searchsorted(offsets, place, side="right") - 1
                        whole = place + width <= offsets[doc + 1]
                        doc, place, run = doc[whole], place[whole], some[hit[whole]]
                        if not len(doc):
                            continue
                        if kind == 2:
                            first = np.maximum(place - AROUND, offsets[doc])
                            end = np.minimum(place + width + AROUND, offsets[doc + 1])
                            found = pa.array([data[a:b].tobytes() for a, b in zip(first.tolist(), end.tolist(), strict=True)], pa.binary())
                            lead = pa.array(place - first, pa.int64())
                        else:
                            order = np.lexsort((run, doc))
                            doc, run = doc[order], run[order]
                            once = np.ones(len(doc), bool)
                            once[1:] = (doc[1:] != doc[:-1]) | (run[1:] != run[:-1])
                            doc, run = doc[once], run[once]
                            found, lead = pa.nulls(len(doc), pa.binary()), pa.nulls(len(doc), pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [batch["doc_id"].take(pa.array(doc)), pa.array(run.view(np.int64)), pa.array(np.full(len(doc), width, np.int64)), found, lead], names=names
                        )
    return work


def _plausible(near: bytes, at: int, width: int, edits: int, context: bytes, lead: int) -> bool:
    """Whether the bytes around a run can be those of its query: an edit spoils one tile, or two that share a character, and moves the others a little."""
    slack, spoilt, most = _SHIFT * edits, 0, edits if near.isascii() else 2 * edits
    for start in (*range(at - TILE, -1, -TILE), *range(at + width, len(near) - TILE + 1, TILE)):
        place = lead + start - at
        if place + TILE + slack <= 0 or context.find(near[start:start + TILE], max(0, place - slack), place + TILE + slack) < 0:
            spoilt += 1
            if spoilt > most:
                return False
    return True


def _checked_around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch[c].to_pylist() for c in ("near", "at", "width", "edits", "context", "lead")), strict=True)
        keep = pa.array([r[4] is None or _plausible(*r) for r in rows], pa.bool_())
        yield batch.select(["query_id", "part", "doc_id", "needed", "run"]).filter(keep)


def _with_edits(threshold: float):
    """Checks the queries of every row on its whole texts, batch by batch."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["asked"]
            rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            pairs = lists.flatten()
            ids, asked = pairs.field("query_id"), pairs.field("query").to_pylist()
            found = []
            for field in WEIGHTS:
                texts = batch[field].to_pylist()
                found.append(_fewest_edits([texts[r] for r in rows], asked, threshold))
            met = [k for k, edits in enumerate(zip(*found, strict=True)) if any(e is not None for e in edits)]
            take = pa.array(met, pa.int64())
            edits = [pa.array([column[k] for k in met], pa.int32()) for column in found]
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), batch["doc_id"].take(pa.array(rows[met], pa.int64())), pa.array([len(asked[k]) for k in met], pa.int32()), *edits],
                names=["query_id", "doc_id", "length", *(f"{f}_edits" for f in WEIGHTS)],
            )
    return work


def candidates(folded: DataFrame, asked: DataFrame, threshold: float) -> DataFrame:
    """(query_id, doc_id) pairs that the check of whole texts has to see.

    With k edits a query keeps one of its k + 1 pieces unchanged, and the other bytes around that piece
    are spoilt in k places at most. Texts are cut in runs in numpy; filters of
    fixed size, one bit per slot of a hash, keep those that queries may use, a join tells
    which they do, and the bytes around the run decide. Building the filters is one job over the queries.
    """
    fields = ", ".join(f"{name} {'binary' if name == 'near' else 'long'}" for name in _RUN_FIELDS)
    runs = checkpointed(asked.select("query_id", "query").mapInArrow(_asked_runs(threshold), f"query_id {_kind(asked, 'query_id')}, {fields}"))
    # at most 2 ** SLOT_BITS / 64 rows for each filter, whatever the number of queries
    words = runs.groupBy((F.col("edits") > 0).alias("loose"), F.expr("slot div 64").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.expr("int(slot % 64)"))).alias("bits"),
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("width").cast("int"))).alias("widths"),
    ).collect()
    filters, used = np.zeros((2, 1 << SLOT_BITS >> 6), np.int64), 0
    for loose, word, bits, widths in words:
        filters[int(loose), word] = bits
        used |= widths
    lengths = [w for w in range(1, RUN + 1) if used >> w & 1]
    texts = folded.select("doc_id", F.concat_ws("\n", *WEIGHTS).alias("text"))
    doc, query = _kind(folded, "doc_id"), _kind(asked, "query_id")
    held = texts.mapInArrow(_held_runs(filters[0].tobytes(), filters[1].tobytes(), lengths), f"doc_id {doc}, run long, width long, context binary, lead long")
    met = held.join(runs.drop("slot"), ["run", "width"]).where(F.col("context").isNull() == (F.col("edits") == 0))
    kept = met.mapInArrow(_checked_around, f"query_id {query}, part long, doc_id {doc}, needed long, run long")
    # a text that is cut in two blocks can hold a run twice
    whole = kept.groupBy("query_id", "part", "doc_id", "needed").agg(F.count_distinct("run").alias("n")).where("n = needed")
    return whole.select("query_id", "doc_id").distinct()


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def match_documents(documents: DataFrame, queries: DataFrame, fuzzy: bool = True) -> DataFrame:
    """Score every (query, document) pair that matches.

    ``documents``: doc_id, title, section, text. ``queries``: query_id, query. Empty and
    null queries match nothing; equal queries are worked on once. A document that meets a
    candidate of some query is read once more, with the list of its queries, at most
    ``_QUERIES_AT_ONCE`` in a row; only pairs of ids are shuffled, and the texts of such documents where Spark
    does not send the lists to them.
    """
    threshold = THRESHOLD if fuzzy else 0.0
    every = queries.select(F.col("query_id").alias("of"), F.lower("query").alias("query")).where(F.length("query") > 0)
    asked = checkpointed(every.groupBy("query").agg(F.min("of").alias("query_id")))
    folded = documents.select("doc_id", *(F.lower(f).alias(f) for f in WEIGHTS))
    pairs = candidates(folded, asked, threshold)

    numbered = pairs.join(pairs.groupBy("doc_id").agg(F.count("*").alias("n")), "doc_id")
    part = F.pmod(F.xxhash64("query_id"), F.ceil(F.col("n") / _QUERIES_AT_ONCE))
    lists = (
        numbered.select("doc_id", "query_id", part.alias("part")).join(asked, "query_id")
        .groupBy("doc_id", "part").agg(F.collect_list(F.struct("query_id", "query")).alias("asked"))
    )
    fields = [f"{f}_edits" for f in WEIGHTS]
    checked = folded.join(lists.drop("part"), "doc_id").mapInArrow(
        _with_edits(threshold),
        f"query_id {_kind(asked, 'query_id')}, doc_id {_kind(folded, 'doc_id')}, length int, " + ", ".join(f"{f} int" for f in fields),
    )
    gained = [
        F.coalesce(weight * (1 - F.col(f"{field}_edits") / F.col("length")), F.lit(0.0))
        for field, weight in WEIGHTS.items()
    ]
    score = F.round(sum(gained[1:], gained[0]) / sum(WEIGHTS.values()), 9)
    found = checked.select("query_id", "doc_id", score.alias("score"), F.least(*fields).alias("edits"))
    same = every.join(asked, "query").select("query_id", "of")
    return found.join(same, "query_id").select(F.col("of").alias("query_id"), "doc_id", "score", "edits")


def top_hits(scored: DataFrame, limit: int = RESULT_LIMIT) -> DataFrame:
    """Best documents per query with their rank.

    Spark keeps only the first ``limit`` rows per query and task before the shuffle.
    """
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def present_hits(hits: DataFrame, documents: DataFrame, queries: DataFrame) -> DataFrame:
    """Hits with document fields, the query added to the link, and a snippet.

    The side that travels is Spark's choice, from measured sizes.
    """
    asked = hits.join(queries.select("query_id", "query"), "query_id")
    return documents.join(asked, "doc_id").select(
        "query_id", "doc_id", "rank", "score", "title", "section",
        F.col("href").alias("link"),
        text.add_parameter("href", QUERY_PARAMETER, "query").alias("href"),
        text.snippet("text", "query").alias("text"),
    )


def group_by_page(hits: DataFrame, link: str = "link") -> DataFrame:
    """Order hits page by page: pages by their best rank, a page's own row in front.

    Works on ranked hits, so a query has at most the result limit of rows.
    """
    page, whole = text.link_page(link), text.link_is_page(link)
    paged = hits.withColumns({"page": page, "is_page": whole})
    in_page = W.partitionBy("query_id", "page")
    by_query = W.partitionBy("query_id")
    # a later whole-page row moves in front of an earlier one
    front = F.when(F.col("is_page"), -F.col("rank")).otherwise(F.lit(0))
    return (
        paged.withColumn("page_first", F.min("rank").over(in_page))
        .withColumn("page_order", F.dense_rank().over(by_query.orderBy("page_first")))
        .withColumn("page_hits", F.count(F.lit(1)).over(in_page))
        .withColumn("in_page", F.row_number().over(in_page.orderBy(F.desc("is_page"), front, "rank")))
        .drop("page_first")
    )


def collapse(grouped: DataFrame, after: int | bool | None = COLLAPSE_AFTER, expanded: DataFrame | None = None) -> DataFrame:
    """Show the first rows of each page and one row that counts the rest.

    ``after``: None, False or 0 shows all, True means 1. ``expanded`` lists (query_id,
    page) pairs that show everything. Column ``kind`` is doc, item or more.
    """
    limit = int(after) if after else None
    rows = grouped.withColumn("kind", F.when(F.col("in_page") == 1, "doc").otherwise("item"))
    rows = rows.withColumn("more", F.lit(None).cast("bigint"))
    if limit is None:
        return rows.withColumn("shown", F.col("in_page"))
    if expanded is not None:
        opened = expanded.select("query_id", "page").distinct().withColumn("_open", F.lit(True))
        rows = rows.join(opened, ["query_id", "page"], "left")
    else:
        rows = rows.withColumn("_open", F.lit(None).cast("boolean"))
    is_open = F.coalesce(F.col("_open"), F.lit(False))
    # the counting row stands after ``limit`` rows
    slot = limit
    visible = rows.where((F.col("in_page") <= slot) | is_open).withColumn(
        "shown", F.when(F.col("in_page") > slot, F.col("in_page") + 1).otherwise(F.col("in_page"))
    )
    keep = {"query_id", "page", "page_order", "page_hits"}
    rest = (
        rows.where((F.col("in_page") == 1) & (F.col("page_hits") > slot))
        .select(*(
            F.col(c) if c in keep else F.lit(None).cast(grouped.schema[c].dataType).alias(c)
            for c in grouped.columns
        ))
        .withColumns({
            "kind": F.lit("more"), "more": F.col("page_hits") - limit, "shown": F.lit(slot + 1),
        })
    )
    return visible.drop("_open").unionByName(rest)


def page_counts(hits: DataFrame, link: str = "link") -> DataFrame:
    """Matching documents (pages) per query."""
    return hits.groupBy("query_id").agg(F.count_distinct(text.link_page(link)).alias("pages"))


def search(documents: DataFrame, queries: DataFrame, fuzzy: bool = True, limit: int = RESULT_LIMIT,
           after: int | bool | None = COLLAPSE_AFTER) -> DataFrame:
    """The whole search: match, keep the best, present, group by page, collapse."""
    hits = top_hits(match_documents(documents, queries, fuzzy), limit)
    shown = present_hits(hits, documents, queries)
    return collapse(group_by_page(shown), after)


def missing_fields(documents: DataFrame, required: tuple[str, ...] = ("href", "title", "text")) -> DataFrame:
    """How many rows lack each required field."""
    return documents.agg(*(F.count_if(F.col(f).isNull()).alias(f) for f in required)).unpivot(
        [], list(required), "field", "missing"
    )


def valid_documents(documents: DataFrame, required: tuple[str, ...] = ("href", "title", "text")) -> DataFrame:
    """Documents that have every required field."""
    return documents.dropna("any", subset=list(required))


def require_fields(documents: DataFrame, required: tuple[str, ...] = ("href", "title", "text")) -> DataFrame:
    """Fail the job at the first row without a required field, naming the fields."""
    lacking = F.array_compact(F.array(*(F.when(F.col(f).isNull(), F.lit(f)) for f in required)))
    first = required[0]
    message = F.concat(F.lit("missing fields: "), F.array_join(lacking, ", "))
    kind = documents.schema[first].dataType
    checked: Column = F.when(F.size(lacking) == 0, F.col(first)).otherwise(F.raise_error(message).cast(kind))
    return documents.withColumn(first, checked)


def rename_fields(documents: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename ``names[target]`` to ``target`` where it exists and differs."""
    present = {source: target for target, source in names.items()
               if source in documents.columns and source != target}
    kept = documents.drop(*(t for t in present.values() if t in documents.columns))
    return kept.withColumnsRenamed(present)
