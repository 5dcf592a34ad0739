"""Fill-in-middle documents: two cuts at token ends, and the three parts put in another order.

A token is white space and the word after it, or the white space at the end of a text.
The bytes of a text fall into six classes: inside a word, and last of one, each as the first
byte of a character or a later one; white space; and white space at the end of the text. A
wavelet matrix holds the classes of a run of texts, one bit plane per bit of the class, with
counts of the ones before every 64th place. Ranks of three classes add up to the number of token
ends before a place, ranks of two others to the bytes that begin no character; bisection on
these ranks finds the place of any token end. All texts of a run are asked at once.

Texts are dealt as they come: runs of ``RUN`` bytes at most, or one longer text. Nothing is
shuffled, and no text meets another one's task.

Definitions for odd input: a null text is an empty one and stays plain. A null doc_id hashes as
an empty string. Ids may repeat: every row is cut by itself, and rows that are equal are cut
alike. An empty table gives an empty result. Columns other than doc_id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED = 42
RATE = 50  # per cent of texts that are cut
SUFFIX_FIRST = 80  # per cent of those, suffix before prefix
RUN = 1 << 20  # bytes of text in one wavelet matrix, unless one text is longer
#: fixed values: the marks before prefix, suffix and middle
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

INSIDE, INSIDE_LATER, LAST, LAST_LATER, WHITE, TAIL = range(6)
TOKEN_ENDS = (LAST, LAST_LATER, TAIL)
LATER = (INSIDE_LATER, LAST_LATER)  # bytes that do not begin a character
PLANES = 3


class WaveletMatrix:
    """Counts of each symbol before any place of a sequence of small numbers."""

    def __init__(self, symbols: np.ndarray, planes: int = PLANES) -> None:
        self.size, self.planes = len(symbols), []
        for level in reversed(range(planes)):
            bits = (symbols >> level) & 1
            words = np.zeros(len(bits) // 64 + 1, np.uint64)
            packed = np.packbits(bits, bitorder="little")
            words.view(np.uint8)[:len(packed)] = packed
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
            self.planes.append((words, before, self.size - int(before[-1])))
            ones = bits.astype(bool)
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def _ones(self, level: int, place: np.ndarray) -> np.ndarray:
        words, before, _ = self.planes[level]
        at = place >> 6
        below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return before[at] + np.bitwise_count(words[at] & below)

    def rank(self, symbol: int, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each place."""
        first, last = np.zeros_like(place), place
        for level, (_, _, zeros) in enumerate(self.planes):
            low, high = self._ones(level, first), self._ones(level, last)
            if symbol >> (len(self.planes) - 1 - level) & 1:
                first, last = zeros + low, zeros + high
            else:
                first, last = first - low, last - high
        return last - first

    def count(self, symbols: tuple[int, ...], place: np.ndarray) -> np.ndarray:
        """Ranks of several symbols together."""
        return sum(self.rank(s, place) for s in symbols)

    def select(self, symbols: tuple[int, ...], nth: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least place in [low, high] that has ``nth`` of the symbols before it, by bisection on the ranks."""
        low, high = low.copy(), high.copy()
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.count(symbols, middle) >= nth
            high = np.where(enough, middle, high)
            low = np.where(enough, low, np.minimum(middle + 1, high))
        return low


def classes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of every byte of texts that follow each other; ``ends`` are the ends of those that are not empty."""
    white = (data == 32) | ((data >= 9) & (data <= 13))
    close = np.empty(len(data), bool)  # white space or the end of the text follows
    close[:-1] = white[1:]
    close[ends - 1] = True
    later = (data & 0xC0) == 0x80
    found = np.where(white, WHITE, 2 * close + later).astype(np.uint8)
    final = ends - 1
    found[final[white[final]]] = TAIL
    return found


def cuts(data: np.ndarray, bounds: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, ...]:
    """Tokens of each text, the two cuts as places in ``data``, and the characters before the first and between both.

    ``bounds`` has one entry more than there are texts; ``one`` and ``two`` are the hashes that choose the tokens.
    """
    start, end = bounds[:-1], bounds[1:]
    matrix = WaveletMatrix(classes(data, end[end > start]))
    before = matrix.count(TOKEN_ENDS, start)
    n = matrix.count(TOKEN_ENDS, end) - before
    units = np.sort(np.stack([one % (n + 1), two % (n + 1)]), axis=0)
    # no token: the cut is the start itself, which has that many ends before it
    a, b = (matrix.select(TOKEN_ENDS, before + u, start, end) for u in units)
    chars = [stop - begin - (matrix.count(LATER, stop) - matrix.count(LATER, begin)) for begin, stop in ((start, a), (a, b))]
    return n, a, b, *chars


def _arranged(rate: int, suffix_first: int):
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(texts: list[bytes], hashes: np.ndarray) -> tuple[list, ...]:
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
        n, a, b, prefix, middle = cuts(np.frombuffer(b"".join(texts), np.uint8), bounds, hashes[0], hashes[1])
        a, b = a - bounds[:-1], b - bounds[:-1]
        forms, outputs = [], []
        for text, x, y, h3, h4 in zip(texts, a.tolist(), b.tolist(), hashes[2].tolist(), hashes[3].tolist(), strict=True):
            if not text or h3 % 100 >= rate or any(m in text for m in marks):
                forms.append("plain")
                outputs.append(text)
            elif h4 % 100 < suffix_first:
                forms.append("spm")
                outputs.append(b"".join((marks[1], text[y:], marks[0], text[:x], marks[2], text[x:y])))
            else:
                forms.append("psm")
                outputs.append(b"".join((marks[0], text[:x], marks[1], text[y:], marks[2], text[x:y])))
        cut = np.array([f != "plain" for f in forms])
        return n, forms, [pa.array(v, pa.int64(), mask=~cut) for v in (prefix, middle)], outputs

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch["text"].to_pylist()]
            hashes = np.stack([batch[f"h{k}"].to_numpy(zero_copy_only=False) for k in range(1, 5)])
            at = 0
            while at < len(texts):
                stop, size = at + 1, len(texts[at])
                while stop < len(texts) and size + len(texts[stop]) <= RUN:
                    size += len(texts[stop])
                    stop += 1
                n, forms, (prefix, middle), outputs = run(texts[at:stop], hashes[:, at:stop])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(at, stop - at), pa.array(n, pa.int64()), pa.array(forms), prefix, middle, pa.array(outputs, pa.binary())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )
                at = stop
    return work


def transformed(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (tokens), form (plain, psm or spm), prefix_chars, middle_chars and output of every row of ``docs``.

    ``rate`` per cent of the texts are cut, and ``suffix_first`` per cent of these have the suffix first;
    a text that holds a mark is never cut. The digest of seed and doc_id decides, so a repeated run gives the same rows.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    kind = docs.schema["doc_id"].dataType
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), digest.alias("d")).select(
        "doc_id", "text", *[F.conv(F.substring("d", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    )
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.BinaryType()),
    ])
    return rows.mapInArrow(_arranged(rate, suffix_first), schema).withColumn("output", F.col("output").cast("string"))


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that an output and its form came from.

    A cut text holds no mark, and no mark can arise where a part meets one, so each mark is found once.
    """
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    first = lambda text, mark: F.substring_index(text, mark, 1)
    rest = lambda text, mark: F.substring_index(text, mark, -1)
    bare = lambda text: F.substr(text, F.lit(len(PREFIX) + 1))
    middle = rest(output, MIDDLE)
    psm = F.concat(bare(first(output, SUFFIX)), middle, first(rest(output, SUFFIX), MIDDLE))
    spm = F.concat(first(rest(output, PREFIX), MIDDLE), middle, bare(first(output, PREFIX)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


SQL = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
    [('0x' || h[8 * i + 1:8 * i + 8])::BIGINT FOR i IN range(4)] AS g FROM d),
c AS (SELECT *, len(w) AS n, least(g[1] % (len(w) + 1), g[2] % (len(w) + 1)) AS a, greatest(g[1] % (len(w) + 1), g[2] % (len(w) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR g[3] % 100 >= {RATE} THEN 'plain'
        WHEN g[4] % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT doc_id, t, n, form, array_to_string(w[1:a], '') AS x, array_to_string(w[a + 1:b], '') AS y, array_to_string(w[b + 1:], '') AS z FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(y) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || x || '{SUFFIX}' || z || '{MIDDLE}' || y ELSE '{SUFFIX}' || z || '{PREFIX}' || x || '{MIDDLE}' || y END) AS output_sha256,
    sha256(t) AS restored_sha256 FROM p"""
