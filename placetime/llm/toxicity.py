"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text and their beginnings of four, five and six letters, in lower
case, as 32-bit hashes; a term counts once per text. The score is the logistic of
``bias + sum of weights + sum over pairs of terms of <v_i, v_j>``: a pair can mean more, or less,
than its two terms. The factors make the pair sum linear in the number of terms.

The model is fitted in one task on a bounded sample: of the training rows the ``PER_CLASS``
with the least hash of their id, of either label, weighted back to the labels' true shares.
Their terms, not their texts, come together. Terms that occur in either class more often than
chance allows (at most ``TERMS`` of them) get weights; all others have none, so words never seen
and long clean texts do not move the score. Scoring reads every whole text where it lies.

Definitions for odd input: a null text is an empty one and gets the score of no terms. A null
doc_id is the empty text for the hash that sets rows aside. Of repeated labels of an id the
highest counts; null labels are no labels. Repeated rows get equal scores, each its row. Without
labels of both kinds every score is 0. An empty table gives an empty result. Other columns
play no part.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PER_CLASS = 4_000
TERMS = 512
LEAST_SIGNAL = 2.5
FACTORS = 8
EPOCHS = 20
BATCH = 256
RATE = 0.2
DECAY = 1e-4
SEED = 42
FOLDS = 5
STARTS = (4, 5, 6)
REMEMBERED = 300_000

_WORD = re.compile(r"[^\W\d_]+")


def word_terms(word: str) -> list[int]:
    """Hashes of a lower-case word and its beginnings."""
    raw = word.encode("utf-8", "surrogatepass")
    return [zlib.crc32(raw), *(zlib.crc32(b"<" + word[:n].encode("utf-8", "surrogatepass")) for n in STARTS if len(word) >= n)]


def terms(text: str | None) -> np.ndarray:
    """Distinct hashed terms of a text."""
    found = {t for w in set(_WORD.findall((text or "").lower())) for t in word_terms(w)}
    return np.fromiter(found, np.int64, len(found))


@dataclass
class Model:
    """Weights of the machine: bias, and for each term its weight and factors."""

    bias: float
    known: dict[int, int]
    weights: np.ndarray
    factors: np.ndarray
    seen: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def score(self, text: str | None) -> float:
        seen, known = self.seen, self.known
        found: set[int] = set()
        for word in set(_WORD.findall((text or "").lower())):
            own = seen.get(word)
            if own is None:
                own = tuple(known[t] for t in word_terms(word) if t in known)
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen[word] = own
            if own:
                found.update(own)
        at = np.fromiter(sorted(found), np.int64, len(found))
        v = self.factors[at]
        pairs = 0.5 * float((v.sum(0) ** 2 - (v ** 2).sum(0)).sum())
        return float(_logistic(np.float64(self.bias + self.weights[at].sum() + pairs)))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def informative(docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Terms whose share among toxic texts differs from chance, the clearest first."""
    every, inverse = np.unique(np.concatenate(docs), return_inverse=True)
    who = np.repeat(labels, [len(d) for d in docs]).astype(np.float64)
    n, toxic = np.bincount(inverse, minlength=len(every)), np.bincount(inverse, who, minlength=len(every))
    share = labels.mean()
    signal = np.abs(toxic - n * share) / np.sqrt(n * share * (1 - share) + 4)
    order = np.lexsort((every, -signal))[:TERMS]
    return every[order[signal[order] >= LEAST_SIGNAL]]


def fit(docs: list[np.ndarray], labels: np.ndarray, odds: float) -> Model:
    """Machine for term sets and labels of 0 and 1; ``odds`` are those of label 1 among all labels."""
    chosen = informative(docs, labels)
    known = {int(t): i for i, t in enumerate(chosen)}
    x = np.zeros((len(docs), len(chosen)), np.float32)
    for i, d in enumerate(docs):
        at = [known[t] for t in d.tolist() if t in known]
        x[i, at] = 1
    share = odds / (1 + odds)
    weight = np.where(labels == 1, share / max(labels.mean(), 1e-9), (1 - share) / max(1 - labels.mean(), 1e-9))
    chance = np.random.default_rng(SEED)
    bias, w = np.zeros(1, np.float32), np.zeros(len(chosen), np.float32)
    bias[0] = np.log(odds)
    v = chance.normal(0, 0.01, (len(chosen), FACTORS)).astype(np.float32)
    sums = [np.full_like(p, 1e-6) for p in (bias, w, v)]
    for _ in range(EPOCHS):
        order = chance.permutation(len(docs))
        for k in range(0, len(order), BATCH):
            rows = order[k:k + BATCH]
            b = x[rows]
            s = b @ v
            raw = bias + b @ w + 0.5 * (s ** 2 - b @ v ** 2).sum(1)
            g = ((_logistic(raw) - labels[rows]) * weight[rows] / len(rows)).astype(np.float32)
            slopes = [g.sum(keepdims=True), b.T @ g + DECAY * w, b.T @ (g[:, None] * s) - v * (b.T @ g)[:, None] + DECAY * v]
            for p, total, slope in zip((bias, w, v), sums, slopes, strict=True):
                total += slope ** 2
                p -= RATE * slope / np.sqrt(total)
    return Model(float(bias[0]), known, w.astype(np.float64), v.astype(np.float64))


def held_out(doc_id: Column | str) -> Column:
    """Rows that labels are never learned from."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


@F.arrow_udf(T.ArrayType(T.LongType()))
def _terms(texts: pa.Array) -> pa.Array:
    return pa.array([terms(t) for t in texts.to_pylist()], pa.list_(pa.int64()))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model from the labels outside the held-out rows, or None without both kinds.

    The sampled labels are at most 2 * PER_CLASS rows, so they are broadcast to the texts.
    """
    given = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    totals = {r.toxic: r.n for r in given.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    marked = given.withColumn("order", F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(f":{SEED}"))))
    picked = None
    for label in (0, 1):
        own = marked.where(F.col("toxic") == label).orderBy("order", "doc_id").limit(PER_CLASS)
        picked = own if picked is None else picked.union(own)
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(picked.select("doc_id", "toxic")), "doc_id")
        .select("doc_id", "toxic", _terms("text").alias("terms"))
        .groupBy("doc_id", "toxic").agg(F.min("terms").alias("terms"))
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # in the order of ids, whatever order the rows come in
        every = []
        for b in batches:
            flat = b.column(2).flatten().to_numpy()
            sets = np.split(flat, np.cumsum(b.column(2).value_lengths().to_numpy())[:-1])
            every += [(i, y, np.sort(t)) for i, y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), sets, strict=True)]
        every.sort(key=lambda r: r[0])
        y = np.array([r[1] for r in every], np.float64)
        if not every or not 0 < y.mean() < 1:
            return
        m = fit([r[2] for r in every], y, totals[1] / totals[0])
        kinds = pa.list_(pa.float64())
        yield pa.RecordBatch.from_pydict({"bias": [m.bias], "terms": pa.array([list(m.known)], pa.list_(pa.int64())), "weights": pa.array([m.weights.tolist()], kinds), "factors": pa.array([m.factors.ravel().tolist()], kinds)})

    row = rows.repartition(1).mapInArrow(work, "bias double, terms array<long>, weights array<double>, factors array<double>").first()
    if row is None:
        return None
    return Model(row.bias, {t: i for i, t in enumerate(row.terms)}, np.array(row.weights), np.array(row.factors).reshape(-1, FACTORS))


def scorer(model: Model | None) -> Callable[[Column | str], Column]:
    """A function from a text column to the column of its scores."""
    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t) if model else 0.0 for t in texts.to_pylist()], pa.float64())

    return score


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text)."""
    score = scorer(train(docs, labels))("text")
    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
