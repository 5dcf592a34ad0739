"""Fill-in-middle against a plain split by the token pattern."""

import hashlib
import re

import numpy as np
import pytest

from placetime.llm import infill

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, rate=infill.RATE, suffix_first=infill.SUFFIX_FIRST):
    text = text or ""
    words = TOKEN.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(words) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(words), "plain", None, None, text
    x, y, z = "".join(words[:a]), "".join(words[a:b]), "".join(words[b:])
    if h[3] % 100 < suffix_first:
        return doc_id, len(words), "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return doc_id, len(words), "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


ODD = [None, "", " ", "\n\t ", "a", " a", "a ", "  a  b\n\nç d\x0b", "é\xa0ü x 😀😀 \x85y", "a<P>b c", "x< y> <", "<S", "\x00 \x00", "<M>", "same words " * 3]
ROWS = [(i, t) for i, t in enumerate(ODD * 8)] + [(None, "no id here"), (None, None), (5, "a b c d"), (5, "a b c d"), (7, " été 😀x\n" * 200_000)]


def test_rows_against_the_plain_version(spark):
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in ROWS], "doc_id long, text string, n int, form string, output string").repartition(5)
    found = infill.transformed(docs)
    got = found.select("*", infill.restored("output", "form").alias("back")).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((plain(*r) for r in ROWS), key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in ROWS)


def test_rates_and_runs(spark, monkeypatch):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = infill.transformed(docs, rate=100, suffix_first=0).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted((plain(*r, 100, 0) for r in ROWS), key=key)
    assert infill.transformed(docs.where("false")).collect() == []


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 1000])
def test_wavelet_matrix(size):
    symbols = np.random.default_rng(size).integers(0, 6, size).astype(np.uint8)
    matrix, places = infill.WaveletMatrix(symbols), np.arange(size + 1)
    for s in range(8):
        assert matrix.rank(s, places).tolist() == [int((symbols[:i] == s).sum()) for i in places]
    total = int(np.isin(symbols, (1, 4)).sum())
    nth, zero, full = np.arange(total + 1), np.zeros(total + 1, np.int64), np.full(total + 1, size)
    ends = [0, *(np.flatnonzero(np.isin(symbols, (1, 4))) + 1)]
    assert matrix.select((1, 4), nth, zero, full).tolist() == ends


def test_all_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {r.doc_id: plain(r.doc_id, r.text) for r in docs.collect()}
    got = infill.transformed(docs).collect()
    assert {r.doc_id: tuple(r) for r in got} == want
