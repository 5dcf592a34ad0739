"""The streaming search against a plain one over the whole text, and exact round trips."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from placetime.llm import pieces

OWN = pieces.codec(pieces.load())
READER = pieces.reader(pieces.load())


def plain(text, own=OWN):
    """Least cost of a path over the whole text, and that of given ids."""
    text = " " + text
    best = [0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - own.longest), end):
            found = own.known.get(text[start:end])
            step = found[0] if found else own.single(text[start])[0] if start == end - 1 else None
            if step is not None and (best[end] is None or best[start] + step < best[end]):
                best[end] = best[start] + step
    return best[-1]


def cost_of(ids, own=OWN):
    return sum(own.byte_cost if own.pieces.kinds[i] == "b" else own.pieces.costs[i] for i in ids)


TEXTS = ["a", " ", "   x", "Hello  world\nfoo\tbar ", "▁ ▁▁x", "ciónñ été ß 漢字 \U0001f600", "x" * 700, "the" * 400 + "\x00\x7f", "trailing  ", "\n\n", "é" * 90]


@pytest.mark.parametrize("text", TEXTS)
def test_best_path_and_round_trip(text):
    ids = OWN.encode(text)
    assert cost_of(ids) == plain(text)
    assert READER.decode(ids) == text
    whole = [i for part in OWN.search(" " + text) for i in part]
    assert cost_of(whole) == plain(text) and READER.decode(whole) == text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcdeinorst éñ▁\n 漢.", max_size=120))
def test_random_texts(text):
    ids = OWN.encode(text)
    assert READER.decode(ids) == text and (not text or cost_of(ids) == plain(text))


def test_ids_come_before_the_text_ends():
    parts = list(OWN.search("internationalization" * 200))
    assert len(parts) > 10 and max(map(len, parts)) < 200


def test_unigram_scores_of_a_small_vocabulary():
    small = pieces.Codec(pieces.Pieces(("▁", "a", "b", "ab", "aba", "ba", "▁ab", "<0x0A>"), (9, 5, 5, 7, 12, 6, 8, 30), "nnnnnnnb"))
    for text in ("abab", "ababa" * 30, "a\nb"):
        assert cost_of(small.encode(text), small) == plain(text, small) and pieces.reader(small.pieces).decode(small.encode(text)) == text


def test_columns(spark):
    rows = [(1, None, 0), (1, "", 0), (None, "a b", 1), (None, "a b", 1), (2, "long " * 50_000, 2), (3, "z" * 60_000, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = df.select("doc_id", "text", pieces.encoder()("text").alias("found")).withColumn("again", pieces.decoder()("found"))
    got = out.collect()
    assert len(got) == 6 and all(r.again == r.text for r in got)
    assert [r.found for r in got if r.text == ""] == [[]] and [r.found for r in got if r.text is None] == [None]
    assert df.limit(0).select(pieces.encoder()("text")).collect() == []


def test_all_documents(spark, sf):
    df = pieces.encoded(spark.read.parquet(f"{sf}/documents.parquet")).withColumn("again", pieces.decoder()("ids"))
    for r in df.collect():
        assert r.again == r.text
    for r in df.limit(20).collect():
        assert cost_of(r.ids) == plain(r.text)


def test_real_documents_are_streamed(spark, sf):
    own = pieces.Codec(pieces.load())
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    found = list(own.encode_many(texts))
    assert own.commits > 10 and all(READER.decode(ids.tolist()) == t for ids, t in zip(found, texts, strict=True))


def test_the_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "MEMORY", 40_000)
    monkeypatch.setattr(pieces, "AHEAD", 50)
    own = pieces.Codec(pieces.load())
    texts = [f"word{i} other{i % 7}" for i in range(2000)]
    found = list(own.encode_many(texts))
    assert all(READER.decode(ids.tolist()) == t for ids, t in zip(found, texts, strict=True))
    size = lambda kept: sum(pieces.ENTRY + 2 * len(c) + len(ids) for c, ids in kept.items())
    assert 0 < size(own.late) <= 20_000 and 0 < size(own.before) <= 20_000


def test_check_in_the_same_worker(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b")], "doc_id long, text string")
    got = pieces.encoded(df, check="ok", keep_text=False)
    assert got.columns == ["doc_id", "ids", "ok"] and all(r.ok for r in got.collect())
