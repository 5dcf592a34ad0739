"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text is read once from left to right. For every position the search keeps the cheapest
path of pieces that ends there and the position it came from, for the last positions only:
no piece is longer than the window, so older ones cannot be left any more. As soon as the
paths of all positions in the window run through one boundary, the ids up to it are
final; they are given out and their positions forgotten. Memory is the window and the
stretch on which paths stay apart, not the text.

A boundary that no piece of the vocabulary can cross is such a boundary for every path.
Texts are cut there first (before a run of spaces, around characters that occur in no longer
piece). A cut that is longer than the window is streamed, and gives out ids as soon as its paths meet.
Cuts that fit in the window as a whole go through the search together with others of one
length. Equal cuts of some hundred thousand are searched once, and a memory of a fixed
number of bytes keeps the ids of those that came last, since words repeat.

Costs are whole numbers, so equal sums are equal. A model whose scores are fractions has log
probabilities, and a path costs their negative sum: the search of the unigram model. A model
whose scores are whole numbers has merge ranks, which do not add up; a piece of rank r then
counts as probability 1 / (r + 100), the usual law of ranked frequencies. That gives the best
path under the law, which is not always the one that applying merges in order gives. Ties
go to the longer last piece.

As in the model's format a space is part of the following piece and every text starts with an
additional space. Bytes of a character that is no piece become byte pieces, dearer than all
other pieces. The mark that stands for a space in the vocabulary file, if it occurs in a
text, becomes byte pieces as well, so decoding gives every text back exactly.

Definitions for odd input: a null text or null ids give null, an empty text an empty
array. Very long texts take time in proportion to their length. Rows are handled one by one:
repeated rows, null ids and other columns do not matter, and an empty table stays empty.
Decoding skips ids of control pieces; bytes that are no UTF-8 become replacement characters.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"  # fixed value: the mark for a space in vocabulary files
SHIFT = 100
UNIT = 1_000_000
MEMORY = 24 << 20  # bytes, about, of the cuts and ids that a worker remembers
ENTRY = 250  # bytes of an entry besides its characters and ids, about
AHEAD = 100_000  # cuts whose texts are looked at together
TOGETHER = 10_000  # cuts of one length in one search
ROWS = 1_000  # texts that are given back together
FACTOR = np.uint64(0x9E3779B97F4A7C15)  # of the polynomial hash of a piece
NEVER = np.int64(1 << 60)


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: what tasks need of a model file."""

    texts: tuple[str, ...]
    costs: tuple[int, ...]
    #: what a piece is: "n" normal, "b" a byte, "c" control or unknown
    kinds: str


@cache
def load(path: str = MODEL) -> Pieces:
    """Read a model file on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    kinds = "".join("b" if model.is_byte(i) else "c" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "n" for i in ids)
    scores = [model.get_score(i) for i in ids]
    ranks = all(s == int(s) for s, k in zip(scores, kinds, strict=True) if k == "n")
    used = [s for s, k in zip(scores, kinds, strict=True) if k == "n" and s > -1e8]
    cost = (lambda s: math.log(SHIFT - s)) if ranks else (lambda s: -s)
    dearest = max(map(cost, used))
    costs = tuple(round(UNIT * (dearest + 1 if k != "n" else cost(s) if s > -1e8 else dearest)) for s, k in zip(scores, kinds, strict=True))
    return Pieces(tuple(model.id_to_piece(i) for i in ids), costs, kinds)


@dataclass
class Codec:
    """Encoder and decoder of one vocabulary, built once per worker."""

    pieces: Pieces
    known: dict[str, tuple[int, int]] = field(default_factory=dict)
    #: ids of cuts as bytes: those of late, and those of before; the latter go when the former are half the memory
    late: dict[str, bytes] = field(default_factory=dict)
    before: dict[str, bytes] = field(default_factory=dict)
    held: int = 0
    commits: int = 0  # how often a streamed cut gave out ids before its end

    def __post_init__(self) -> None:
        texts = [t.replace(SPACE, " ") for t in self.pieces.texts]
        self.known = {t: (c, i) for i, (t, c, k) in enumerate(zip(texts, self.pieces.costs, self.pieces.kinds, strict=True)) if k == "n"}
        self.longest = max(map(len, self.known), default=1)
        #: cost of a piece; None for what only longer pieces start with
        self.starts = {t[:n]: None for t in self.known for n in range(1, len(t))} | {t: c for t, (c, _) in self.known.items()}
        marked = sorted((self.mark(t), int(NEVER) if c is None else c, -1 if c is None else self.known[t][1]) for t, c in self.starts.items())
        self.marks = np.array([m for m, _, _ in marked], np.uint64)
        self.mark_costs = np.array([c for _, c, _ in marked], np.int64)
        self.mark_ids = np.array([i for _, _, i in marked], np.int32)
        if len(set(self.marks.tolist())) < len(marked):
            raise ValueError("two starts of pieces have one hash")
        self.byte_ids = {int(t[1:-1], 16): i for i, (t, k) in enumerate(zip(texts, self.pieces.kinds, strict=True)) if k == "b"}
        self.byte_cost = max(self.pieces.costs, default=1)
        inside = {c for t in self.known if len(t) > 1 for c in t}
        alone = "".join(c for c in "\n\t\r" if c not in inside)
        spaced = all(" " not in t.lstrip(" ") for t in self.known)
        self.cuts = re.compile(rf"[{re.escape(alone)}]| *[^ {re.escape(alone)}]+| +" if alone and spaced else r"(?s).+")

    @staticmethod
    def mark(piece: str) -> int:
        total = 0
        for c in piece:
            total = (total * int(FACTOR) + ord(c)) & (2**64 - 1)
        return total

    def single(self, char: str) -> tuple[int, list[int]]:
        """Cost and ids of one character that is no piece: its bytes."""
        raw = char.encode("utf-8", "surrogatepass")
        return self.byte_cost * len(raw), [self.byte_ids[b] for b in raw]

    def search(self, text: str) -> Iterator[list[int]]:
        """Ids of a text in the order and as soon as they are final."""
        starts, longest, size = self.starts, self.longest, len(text)
        final, look = 0, longest  # all paths run through final, and ids before it are given out
        cost: list[int | None] = [0] + [None] * min(size, longest)
        came = [0] * len(cost)  # both from position final on
        for at in range(size):
            base, step = cost[at - final], None
            for end in range(at + 1, min(at + longest, size) + 1):
                step = starts.get(text[at:end], 0)
                if step is None:
                    continue  # longer pieces start so
                if step == 0:
                    if end > at + 1:
                        break
                    step = self.single(text[at])[0]
                old = cost[end - final]
                if old is None or base + step < old:
                    cost[end - final], came[end - final] = base + step, at
            if cost[at + 1 - final] is None:
                step = base + self.single(text[at])[0]
                cost[at + 1 - final], came[at + 1 - final] = step, at
            if at + 1 - final >= look:
                boundary = self.meeting(cost, came, at, final)
                look = longest if boundary > final else 2 * look  # paths that stay apart are not walked at every step
                if boundary > final:
                    yield self.path(text, came, final, boundary, final)
                    del cost[:boundary - final], came[:boundary - final]
                    final = boundary
            if at + 1 + longest <= size:
                cost.append(None)
                came.append(0)
        if final < size:
            yield self.path(text, came, final, size, final)

    def meeting(self, cost: list[int | None], came: list[int], at: int, final: int) -> int:
        """The last boundary on the paths to all positions after ``at`` that pieces have reached."""
        live = {p for p in range(at + 1, final + len(cost)) if cost[p - final] is not None}
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(came[last - final] if last > final else final)
        return live.pop()

    def path(self, text: str, came: list[int], start: int, end: int, final: int) -> list[int]:
        cuts = [end]
        while cuts[-1] > start:
            cuts.append(came[cuts[-1] - final])
        ids: list[int] = []
        for a, b in zip(cuts[:0:-1], cuts[-2::-1], strict=True):
            found = self.known.get(text[a:b])
            ids += [found[1]] if found else self.single(text[a])[1]
        return ids

    def search_many(self, cuts: list[str]) -> Iterator[tuple[int, ...]]:
        """Ids of cuts of one length: the same search, for all of them position by position."""
        size, many = len(cuts[0]), len(cuts)
        chars = np.frombuffer("".join(cuts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(many, size).T.astype(np.uint64)
        raw = self.byte_cost * (1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF))
        cost = np.full((size + 1, many), NEVER, np.int64)
        came = np.zeros((size + 1, many), np.int16)
        last = np.full((size + 1, many), -1, np.int32)  # id of the piece that ends here; -1 for bytes
        cost[0] = 0
        for start in range(size):
            open_ = np.arange(many)  # cuts in which a piece can still go on
            mark = np.zeros(many, np.uint64)
            for end in range(start + 1, min(start + self.longest, size) + 1):
                mark = mark * FACTOR + chars[end - 1][open_]
                at = np.minimum(np.searchsorted(self.marks, mark), len(self.marks) - 1)
                hit = self.marks[at] == mark
                step = np.where(hit, self.mark_costs[at], NEVER)
                own = np.where(step == NEVER, -1, self.mark_ids[at])
                if end == start + 1:
                    step = np.where(step == NEVER, raw[start], step)
                total = cost[start][open_] + step
                better = total < cost[end][open_]
                cost[end][open_[better]] = total[better]
                came[end][open_[better]] = start
                last[end][open_[better]] = own[better]
                open_, mark = open_[hit], mark[hit]
                if not len(open_):
                    break
        # all paths back together: ids from the last to the first, and how many
        found, count = np.zeros((size, many), np.int32), np.zeros(many, np.int64)
        every, end, raw_piece = np.arange(many), np.full(many, size), np.zeros(many, bool)
        while len(every):
            own = last[end[every], every]
            raw_piece[every] |= own < 0
            found[count[every], every] = own
            count[every] += 1
            end[every] = came[end[every], every]
            every = every[end[every] > 0]
        flat = found[::-1].T[(np.arange(size)[::-1] < count[:, None])].astype(np.int32).tobytes()
        stop = np.cumsum(count * 4)
        for text, first, until, raw_, column in zip(cuts, (stop - count * 4).tolist(), stop.tolist(), raw_piece.tolist(), range(many), strict=True):
            yield self.with_bytes(text, came[:, column], last[:, column]) if raw_ else flat[first:until]

    def with_bytes(self, text: str, came: np.ndarray, last: np.ndarray) -> bytes:
        """Ids of a cut on whose path characters become bytes."""
        out, end = [], len(text)
        while end:
            start = int(came[end])
            out.append([int(last[end])] if last[end] >= 0 else self.single(text[start])[1])
            end = start
        return np.array([i for part in out[::-1] for i in part], np.int32).tobytes()

    def streamed(self, cut: str) -> bytes:
        """Ids of a cut longer than the window."""
        parts = list(self.search(cut))
        self.commits += len(parts) - 1
        return np.array([i for part in parts for i in part], np.int32).tobytes()

    def learn(self, cuts: set[str]) -> dict[str, bytes]:
        """Ids of cuts, remembered or searched."""
        late, before = self.late, self.before
        found = {c: ids for c in cuts if (ids := late.get(c) or before.get(c)) is not None}
        by_length: dict[int, list[str]] = {}
        new: dict[str, bytes] = {}
        for cut in cuts - found.keys():
            if len(cut) > self.longest:
                new[cut] = self.streamed(cut)
            else:
                by_length.setdefault(len(cut), []).append(cut)
        for same in by_length.values():
            for k in range(0, len(same), TOGETHER):
                new.update(zip(same[k:k + TOGETHER], self.search_many(same[k:k + TOGETHER]), strict=True))
        for cut, ids in new.items():
            size = ENTRY + 2 * len(cut) + len(ids)
            if size > MEMORY // 100:
                continue
            if self.held + size > MEMORY // 2:
                self.late, self.before, self.held = {}, self.late, 0
            self.late[cut] = ids
            self.held += size
        return found | new

    def encode_many(self, texts: list[str | None]) -> Iterator[np.ndarray | None]:
        """Ids of each text, some texts at a time."""
        held: list[list[str] | None] = []
        room = 0
        for k, text in enumerate(texts):
            held.append(None if text is None else self.cuts.findall(" " + text) if text else [])
            room += len(held[-1] or ())
            if room > AHEAD or k == len(texts) - 1:
                ids_of = self.learn({c for cuts in held if cuts for c in cuts}).__getitem__
                for cuts in held:
                    yield None if cuts is None else np.frombuffer(b"".join(map(ids_of, cuts)), np.int32)
                held, room = [], 0

    def encode(self, text: str) -> list[int]:
        return next(self.encode_many([text])).tolist()


@dataclass(frozen=True)
class Reader:
    """Decoder of one vocabulary: the bytes of every piece."""

    table: tuple[bytes, ...]

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.table.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


@cache
def reader(pieces: Pieces) -> Reader:
    rows = zip(pieces.texts, pieces.kinds, strict=True)
    return Reader(tuple(bytes([int(t[1:-1], 16)]) if k == "b" else b"" if k == "c" else t.replace(SPACE, " ").encode() for t, k in rows))


@cache
def codec(pieces: Pieces) -> Codec:
    return Codec(pieces)


def encoder(pieces: Pieces | None = None) -> Callable[[Column | str], Column]:
    """A function from a text column to the column of its ids."""
    pieces = pieces or load()

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pa.Array) -> pa.Array:
        return pa.array(list(codec(pieces).encode_many(texts.to_pylist())), pa.list_(pa.int32()))

    return encode


def encoded(docs: DataFrame, pieces: Pieces | None = None, text: str = "text", into: str = "ids", check: str | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` with the ids of a text column in a new column, worked out once per row.

    ``check`` names a column that says whether the ids decode to the text, found in the same
    worker. Without ``keep_text`` the text does not come back.
    """
    pieces = pieces or load()
    place = docs.columns.index(text)
    kept = [k for k in range(len(docs.columns)) if keep_text or k != place]
    added = [T.StructField(into, T.ArrayType(T.IntegerType()))] + ([T.StructField(check, T.BooleanType())] if check else [])
    schema = T.StructType([*(docs.schema.fields[k] for k in kept), *added])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(pieces)
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                b = whole.slice(at, ROWS)
                texts = b.column(place).to_pylist()
                found = list(own.encode_many(texts))
                made = [pa.array(found, pa.list_(pa.int32()))]
                if check:
                    decode = reader(pieces).decode
                    made.append(pa.array([t is None if ids is None else decode(ids.tolist()) == t for t, ids in zip(texts, found, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), *made], names=schema.names)

    return docs.mapInArrow(work, schema)


def decoder(pieces: Pieces | None = None) -> Callable[[Column | str], Column]:
    """A function from a column of ids to the column of their texts."""
    pieces = pieces or load()

    @F.arrow_udf(T.StringType())
    def decode(ids: pa.Array) -> pa.Array:
        own = reader(pieces)
        return pa.array([own.decode(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else None for x in ids], pa.string())

    return decode
