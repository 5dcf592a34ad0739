"""Document scores by masked pseudo-likelihood.

A small network sees the two words before and the two after a place, not the word in it, and
gives a probability to every word there. A document's score is the sum of the log
probabilities of its own words, each judged from both sides.

Words are those of the corpus: all documents' words are counted, the most frequent get ids of
their own, and the others share ids by their last two characters. The network gives a probability to
the id; a word that shares one has its part of the id's count, so its log probability is that
of the id plus log(n(word) / n(id)), by the counts of all words. Ids in order of frequency are cut into clusters; the
network first gives a probability to the cluster, then to the id in it.

Texts are read twice: to count, and to turn words into ids, which are written. The counts of up to ``KNOWN``
frequent words go to every task; words beyond are joined with the table of all counts.

Training reads every word of every document. Each task runs gradient steps in numpy over the
rows it reads and gives out its weights; the weights of all tasks are averaged by the words
they saw, in rounds of a bounded fan-in. ``ROUNDS`` such rounds, each over its share of the
documents, start from the average of the one before; the first starts from the counts.

Definitions for odd input: a null or blank text has no words and the score 0. Null ids and
repeated rows are documents like any other. A corpus without words gives a network that was
never trained, and only scores of 0. An empty table gives an empty result. Other columns play
no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetime.session import checkpointed

IDS = 512
SHARED = 128  # ids of words that are not among the most frequent
CLUSTERS = 16
KNOWN = 131_072  # words whose counts every task has
WIDTH = 16
SIDE = (-2, -1, 1, 2)
EDGE = 0  # the id outside a document
BATCH = 4096
PASS = 4 * BATCH  # words judged together: most groups of documents in one pass
RATE = 0.2
ROUNDS = 2
FAN_IN = 32
DOCS = 1000  # documents that are given back together
SEED = 42
ROWS = 500  # rows of a product: more would wake the threads of the algebra library, which gain nothing here
LEAST = np.float32(math.log(1e-30))  # log probability
COUNTED = 500_000  # different words a task counts before it gives them out


@dataclass
class Vocabulary:
    """Ids of words: EDGE, then shared ids, then the most frequent words in order.

    ``words`` has the KNOWN most frequent words at most, ``known`` their counts, ``counts`` those of the ids.
    """

    words: tuple[str, ...]
    known: np.ndarray
    counts: np.ndarray

    def __post_init__(self) -> None:
        room = IDS - 1 - SHARED
        self.place = {w: i for i, w in enumerate(self.words)}
        own = np.arange(1 + SHARED, 1 + SHARED + min(room, len(self.words)))
        self.id_of = np.concatenate([own, [shared_id(w) for w in self.words[room:]]]).astype(np.int16)
        with np.errstate(divide="ignore"):
            self.part_of = np.log(self.known / self.counts[self.id_of])

    def read(self, text: str | None) -> tuple[np.ndarray, float, list[str]]:
        """Ids of a text, the sum of log(n(word) / n(id)) over its known words, and the words that are not known."""
        words = (text or "").split()
        place = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        known = place >= 0
        rare = [words[i] for i in np.flatnonzero(~known)]
        ids = np.empty(len(words), np.int16)
        ids[known] = self.id_of[place[known]]
        ids[~known] = [shared_id(w) for w in rare]
        return ids, float(self.part_of[place[known]].sum()), rare

    def ids(self, text: str | None) -> np.ndarray:
        return self.read(text)[0]


def shared_id(word: str) -> int:
    """Id of a word that is not among the most frequent."""
    return _ending_id(word[-2:])


@lru_cache(1 << 16)
def _ending_id(ending: str) -> int:
    return 1 + xxhash.xxh32_intdigest(ending.encode("utf-8", "surrogatepass")) % SHARED


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; tasks count what they read before anything is shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

        for b in batches:
            for text in b.column(0).to_pylist():
                held.update((text or "").split())
                if len(held) > COUNTED:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counted: DataFrame) -> list:
    """The most frequent words, those with ids of their own first: KNOWN rows at most, and some thousand counters, come to the driver."""
    width = F.greatest(F.length(F.bin("n")) - 7, F.lit(0))
    step = F.call_function("shiftleft", F.call_function("shiftright", F.col("n"), width), width)
    cut, room = None, KNOWN
    for r in sorted(counted.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r.step):
        room -= r.words
        if room < 0:
            break
        cut = r.step
    top = counted.orderBy(F.desc("n"), "word").limit(IDS - 1 - SHARED).collect()
    more = counted.where(F.col("n") >= cut).collect() if cut is not None else []
    return top + sorted(set(more) - set(top), key=lambda r: (-r.n, r.word))


def vocabulary(docs: DataFrame, counted: DataFrame | None = None) -> Vocabulary:
    """The most frequent words and the counts of all ids."""
    counted = checkpointed(word_counts(docs)) if counted is None else counted
    top = frequent(counted)
    own = frozenset(r.word for r in top[:IDS - 1 - SHARED])

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + SHARED, np.int64)
        for b in batches:
            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if w not in own:
                    total[shared_id(w)] += n
        yield pa.RecordBatch.from_pydict({"id": pa.array(np.arange(1 + SHARED)), "n": pa.array(total)})

    counts = np.zeros(IDS, np.int64)
    for r in counted.mapInArrow(share, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r.id] = r.n
    counts[1 + SHARED:1 + SHARED + len(own)] = [r.n for r in top[:len(own)]]
    return Vocabulary(tuple(r.word for r in top), np.array([r.n for r in top], np.int64), counts)


def coded(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """doc_id, mark (a hash of the text), ids as bytes, part and rare of every row; see ``Vocabulary.read``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(words.words, words.known, words.counts)
        for b in batches:
            for at in range(0, b.num_rows, DOCS):
                some = b.slice(at, DOCS)
                found = [own.read(t) for t in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    some.column(0), some.column(1), pa.array([ids.tobytes() for ids, _, _ in found], pa.binary()),
                    pa.array([part for _, part, _ in found], pa.float64()), pa.array([rare for _, _, rare in found], pa.list_(pa.string())),
                ], names=["doc_id", "mark", "ids", "part", "rare"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(work, f"doc_id {kind}, mark long, ids binary, part double, rare array<string>")


SHAPES = {"inner": (len(SIDE), IDS, WIDTH), "bias": (WIDTH,), "cluster": (WIDTH, CLUSTERS), "cluster_bias": (CLUSTERS,), "within": (CLUSTERS, WIDTH, IDS // CLUSTERS), "within_bias": (CLUSTERS, IDS // CLUSTERS)}


class Network:
    """Weights, and the order that puts ids of like frequency in one cluster."""

    def __init__(self, weights: dict[str, np.ndarray], place: np.ndarray) -> None:
        self.weights, self.place = weights, place
        self.cluster, self.inside = (place // (IDS // CLUSTERS)).astype(np.int16), (place % (IDS // CLUSTERS)).astype(np.int16)
        self.slopes = {k: np.full(v.shape, 1e-2, np.float32) for k, v in weights.items()}

    @staticmethod
    def start(counts: np.ndarray) -> Network:
        """Small random weights, and biases that give every id its share of the corpus."""
        place = np.empty(IDS, np.int64)
        place[np.lexsort((np.arange(IDS), -counts))] = np.arange(IDS)
        chance = np.random.default_rng(SEED)
        weights = {k: (chance.normal(0, 0.1, s) if "bias" not in k else np.zeros(s)).astype(np.float32) for k, s in SHAPES.items()}
        share = np.zeros(IDS)
        share[place] = counts + 0.5
        by = share.reshape(CLUSTERS, -1)
        weights["cluster_bias"] = np.log(by.sum(1)).astype(np.float32)
        weights["within_bias"] = np.log(by).astype(np.float32)
        return Network(weights, place)

    @staticmethod
    def windows(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All words of the documents, and the ids around each; EDGE beyond a document's ends."""
        reach = max(SIDE)
        gap = np.full(reach, EDGE, np.int16)
        line = np.concatenate([gap, *(x for d in ids for x in (d, gap))])
        sizes = np.array([len(d) for d in ids])
        starts = reach + np.cumsum(sizes + reach) - sizes - reach
        at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, sizes, strict=True)]) if len(ids) else np.zeros(0, np.int64)
        return line[at], np.stack([line[at + j] for j in SIDE]) if len(at) else np.zeros((len(SIDE), 0), np.int16)

    def hidden(self, around: np.ndarray) -> np.ndarray:
        w = self.weights
        total = w["inner"][0].take(around[0], axis=0)
        total += w["bias"]
        for j in range(1, len(SIDE)):
            total += w["inner"][j].take(around[j], axis=0)
        return np.tanh(total, out=total)

    def _by_cluster(self, target: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, ...]:
        """The order of the words by cluster, where each cluster begins, and in that order cluster, place in it and surroundings."""
        cluster = self.cluster[target]
        order = np.argsort(cluster, kind="stable")  # 16 bits: sorted by counting
        cluster = cluster.take(order)
        return order, np.searchsorted(cluster, np.arange(CLUSTERS + 1)), cluster, self.inside[target.take(order)], around.take(order, axis=1)

    def log_probabilities(self, target: np.ndarray, around: np.ndarray) -> np.ndarray:
        """Log probability of each word from its surroundings."""
        w = self.weights
        order, cuts, cluster, inside, around = self._by_cluster(target, around)
        h = self.hidden(around)
        found = _log_shares(_sums(h, w["cluster"], w["cluster_bias"]), cluster)
        for c in range(CLUSTERS):
            a, b = cuts[c], cuts[c + 1]
            if a < b:
                found[a:b] += _log_shares(_sums(h[a:b], w["within"][c], w["within_bias"][c]), inside[a:b])
        out = np.empty_like(found)
        out[order] = found
        return out

    def learn(self, target: np.ndarray, around: np.ndarray) -> None:
        """One gradient step on the mean log probability."""
        w, n = self.weights, len(target)
        _, cuts, cluster, inside, around = self._by_cluster(target, around)
        h = self.hidden(around)
        at = np.arange(n)
        p = _softmax(_sums(h, w["cluster"], w["cluster_bias"]))
        p[cluster, at] -= 1
        back = np.empty_like(h)
        slopes = {"within": np.zeros_like(w["within"]), "within_bias": np.zeros_like(w["within_bias"])}
        slopes["cluster"], slopes["cluster_bias"] = _back(h, p, w["cluster"], back), p.sum(1)
        for c in range(CLUSTERS):
            a, b = cuts[c], cuts[c + 1]
            if a == b:
                continue
            q = _softmax(_sums(h[a:b], w["within"][c], w["within_bias"][c]))
            q[inside[a:b], at[:b - a]] -= 1
            more = np.empty_like(back[a:b])
            slopes["within"][c], slopes["within_bias"][c] = _back(h[a:b], q, w["within"][c], more), q.sum(1)
            back[a:b] += more
        h *= h
        back *= np.subtract(1, h, out=h)
        slopes["bias"] = back.sum(0)
        # rows of the inner weights, those of all sides in one table
        rows = (around + (np.arange(len(SIDE), dtype=np.int16) * IDS)[:, None]).ravel()
        order = np.argsort(rows, kind="stable")
        found = rows.take(order)
        first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        slopes["inner"] = np.zeros_like(w["inner"])
        slopes["inner"].reshape(-1, WIDTH)[found[first]] = np.add.reduceat(back.take(order % n, axis=0), first)
        for k, slope in slopes.items():
            slope /= n
            self.slopes[k] += slope * slope
            w[k] -= RATE * slope / np.sqrt(self.slopes[k])


# Products keep one column per word: sums over ids then run along the words, whatever few ids a cluster has.

def _sums(h: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Per id (row) and word (column) the weighted sum of what the word's place shows, plus the bias."""
    x = np.empty((weights.shape[1], len(h)), np.float32)
    for k in range(0, len(h), ROWS):
        np.matmul(weights.T, h[k:k + ROWS].T, out=x[:, k:k + ROWS])
    x += bias[:, None]
    return x


def _back(h: np.ndarray, p: np.ndarray, weights: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Slopes of the weights of :func:`_sums`; those of ``h`` go to ``out``."""
    total = np.zeros_like(weights)
    for k in range(0, len(h), ROWS):
        part = p[:, k:k + ROWS].T
        np.matmul(part, weights.T, out=out[k:k + ROWS])
        total += h[k:k + ROWS].T @ part
    return total


def _log_shares(x: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Per word the log of its own id's share; changes ``x``."""
    x -= x.max(0)
    found = x[own, np.arange(len(own))]
    np.exp(x, out=x)
    found -= np.log(x.sum(0))
    return np.maximum(found, LEAST, out=found)


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(0)
    np.exp(x, out=x)
    x /= x.sum(0)
    return np.maximum(x, 1e-30, out=x)


def _grouped(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list[np.ndarray], list[int], pa.RecordBatch]]:
    """Ids of a few documents at a time, about BATCH words or one document."""
    for b in batches:
        held, rows, size = [], [], 0
        texts = b.column(column)
        for i in range(len(texts)):
            held.append(np.frombuffer(texts[i].as_buffer(), np.int16))
            rows.append(i)
            size += len(held[-1])
            if size >= BATCH or i == len(texts) - 1:
                yield held, rows, b
                held, rows, size = [], [], 0


def _average(key: tuple, rows: pa.Table) -> pa.Table:
    """Mean of weight vectors by the words they saw."""
    seen = np.array(rows["seen"].to_pylist(), np.float64)
    total = sum(n * np.frombuffer(x.as_py(), np.float32).astype(np.float64) for n, x in zip(seen, rows["vector"], strict=True))
    mean = (total / seen.sum()).astype(np.float32).tobytes()
    return pa.table({"part": [key[0].as_py()], "seen": [float(seen.sum())], "vector": pa.array([mean], pa.binary())})


_VECTORS = "part long, seen double, vector binary"


def trained(read: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> Network:
    """Network after ``rounds`` rounds over ``coded`` documents; each is read for training in one of them."""
    net = Network.start(words.counts)
    names, place = list(SHAPES), net.place
    for k in range(rounds):
        weights = net.weights

        def work(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            own, total, part = Network({n: v.copy() for n, v in weights.items()}, place), 0, None
            for ids, _, b in _grouped(batches, 0):
                part = b.column(1)[0].as_py() if part is None else part
                target, around = own.windows(ids)
                for a in range(0, len(target), BATCH):
                    own.learn(target[a:a + BATCH], around[:, a:a + BATCH])
                total += len(target)
            if total:
                vector = np.concatenate([own.weights[n].ravel() for n in names]).tobytes()
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "seen": pa.array([float(total)]), "vector": pa.array([vector], pa.binary())})

        share = read.where(F.pmod("mark", F.lit(rounds)) == k)
        vectors = checkpointed(share.select("ids", F.spark_partition_id().cast("long").alias("part")).mapInArrow(work, _VECTORS))
        parts = vectors.agg(F.max("part")).first()[0]
        if parts is None:
            continue
        while True:
            parts //= FAN_IN
            vectors = vectors.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part").applyInArrow(_average, _VECTORS)
            if parts == 0:
                break
        flat, at, new = np.frombuffer(bytes(vectors.first().vector), np.float32), 0, {}
        for n in names:
            size = math.prod(SHAPES[n])
            new[n] = flat[at:at + size].reshape(SHAPES[n]).copy()
            at += size
        net = Network(new, place)
    return net


def rare_parts(read: DataFrame, words: Vocabulary, counted: DataFrame) -> DataFrame:
    """(mark, rest): per hash of a text the sum of log(n(word) / n(id)) over its words that are not known."""
    own, totals = frozenset(words.words), words.counts

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(w, math.log(n / totals[shared_id(w)])) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if w not in own]
            yield pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in rows], pa.string()), "rest": pa.array([p for _, p in rows], pa.float64())})

    # outer: else Spark filters on the array first
    held = read.select("mark", F.explode_outer("rare").alias("word")).where(F.col("word").isNotNull())
    sums = held.join(counted.mapInArrow(part, "word string, rest double"), "word").groupBy("mark").agg(F.sum("rest").alias("sum"))
    # rows of equal texts add up alike: their sum is shared out again
    return sums.join(read.groupBy("mark").agg(F.count("*").alias("copies")), "mark").select("mark", (F.col("sum") / F.col("copies")).alias("rest"))


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, score (sum of log probabilities) and per_word for every row of ``docs``."""
    counted = checkpointed(word_counts(docs))
    words = vocabulary(docs, counted)
    read = checkpointed(coded(docs, words))
    net = trained(read, words)
    weights, place, kind = net.weights, net.place, dict(docs.dtypes)["doc_id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(weights, place)
        for ids, rows, b in _grouped(batches, 1):
            some = b.slice(rows[0], len(rows))
            sizes = np.array([len(d) for d in ids])
            target, around = own.windows(ids)
            found = np.concatenate([own.log_probabilities(target[a:a + PASS], around[:, a:a + PASS]) for a in range(0, len(target), PASS)] or [np.zeros(0)])
            upto = np.concatenate(([0.0], np.cumsum(found, dtype=np.float64)))
            ends = np.cumsum(sizes)
            score = upto[ends] - upto[ends - sizes] + some.column(3).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pydict({"doc_id": some.column(0), "n_words": pa.array(sizes, pa.int64()), "score": pa.array(score), "mark": some.column(2)})

    by_id = read.select("doc_id", "ids", "mark", "part").mapInArrow(work, f"doc_id {kind}, n_words long, score double, mark long")
    joined = by_id.join(rare_parts(read, words, counted), "mark", "left").withColumn("score", F.col("score") + F.coalesce("rest", F.lit(0.0)))
    return joined.select("doc_id", "n_words", "score", (F.col("score") / F.greatest("n_words", F.lit(1))).alias("per_word"))
