"""Archives against plain records, and exact round trips."""

import base64
import glob
import hashlib

import pytest
import zstandard

from placetime.llm import warc


def plain(rows, least=0):
    """Contract columns of (page_id, url, html) rows."""
    first = {}
    for p, _u, h in rows:
        b = (h or "").encode()
        if p is not None and len(b) >= least:
            first[b] = min(first.get(b, p), p)
    out = []
    for p, _u, h in rows:
        b = (h or "").encode()
        f = first.get(b) if len(b) >= least else None
        refers = f if p is not None and f is not None and p != f else f if p is None and f is not None else None
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    got = warc.archived(pages).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == plain(rows)
    html = {p: h for p, _, h in rows}
    urls = {p: u for p, u, _ in rows}
    for r in got:
        assert r.url == urls[r.page_id]
        if r.record_type == "response":
            assert bytes(r.payload).decode() == (html[r.page_id] or "")


@pytest.mark.parametrize("least", [0, 4])
def test_odd_rows(spark, least):
    rows = [(3, "u\r\nv%", "same", "x"), (1, None, "same", "x"), (1, None, "same", "x"), (2, "a", None, "x"), (4, "b", "", "x"), (None, "c", "same", "x"), (5, "d", "é" * 1_000_000, "x"), (6, "e", "abc", "x"), (7, "f", "abc", "x"), (8, "g", "a\r\n\r\nb", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    got = warc.archived(pages, least).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == plain([r[:3] for r in rows], least)
    assert {r.page_id: r.url for r in got if r.page_id} == {r[0]: r[1] or "" for r in rows if r[0]}
    assert [bytes(r.payload) for r in got if r.page_id == 8] == [b"a\r\n\r\nb"]


def test_bundles_are_seekable_and_readable_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME", 2_000)
    writer = warc._Writer(str(tmp_path))
    raw = [warc.record(i, f"http://x/{i}", b"p" * (i * 37 % 900), None) for i in range(60)]
    for i, r in enumerate(raw):
        writer.add(i, r)
    rows = writer.end_bundle()
    path, = glob.glob(f"{tmp_path}/*.warc.zst")
    data = open(path, "rb").read()
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole == b"".join(raw)
    with warc.pa.OSFile(path) as f:
        table = warc.read_seek_table(f, len(data))
    assert len(table) == rows[-1][2] + 1 > 5 and table[-1][0] + table[-1][1] < len(data)
    for page_id, _, frame, start, packed, at, size in rows:
        assert table[frame][:2] == (start, packed)
        one = zstandard.ZstdDecompressor().decompress(data[start:start + packed], max_output_size=table[frame][2])
        assert one[at:at + size] == raw[page_id]


def test_wanted_records_only(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    index = warc.write(pages, warc.fresh_path(spark, "warc"))
    some = pages.select("page_id").where("page_id % 7 = 0")
    assert sorted(r.page_id for r in warc.read(spark, index, some).collect()) == sorted(r.page_id for r in some.collect())


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived(pages).collect() == []
