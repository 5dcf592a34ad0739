"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames; each frame is compressed on its own, and frames follow each
other in bundle files. A bundle ends in a seek table: a skippable frame that lists the
compressed and the plain length of every frame, in the public seekable format, so that any
Zstandard reader still reads the whole file. An index table maps each record to its bundle,
frame and the offset and length inside the plain frame. A record is read by one seek and by
decompressing one frame.

Of records with equal payloads the one with the smallest page_id is a response and the
others revisit it; payloads shorter than ``least`` bytes are all responses. Payload
digests are SHA-1 in base 32.

Tasks write files under names of their own in a folder that all executors reach; only files
that the index names belong to the archive, so a task that is lost or runs twice does no
harm. Reading deals frames, not files, to tasks.

Definitions for odd input: a null html is an empty payload, a null url an empty target. Rows
that repeat the smallest page_id of a payload are all responses. A null page_id
revisits the response of its payload where there is one, and else is a response. A long record
gets a frame of its own. An empty table gives no bundles and no rows. Other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import math
import struct
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetime.session import fresh_path

FRAME = 1 << 18  # plain bytes after which a frame ends
BUNDLE = 1 << 27  # compressed bytes after which a bundle ends
LEVEL = 3
TOGETHER = 64  # frames of a bundle that one task reads after each other
TASK = 1 << 28  # plain bytes of a reading task, about
DATE = "2024-01-01T00:00:00Z"  # pages carry no fetch time

# fixed values of the WARC and seekable Zstandard formats
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
END = b"\r\n\r\n"

INDEX = "page_id long, bundle string, frame int, frame_start long, frame_bytes long, record_start long, record_bytes long"
RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    """Record id of a page: the same page gets the same name in every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _plain(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_name(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": _plain(url or ""),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "X-Payload-Length": str(len(payload)),
        "X-Page": "" if page_id is None else str(page_id),
    }
    if refers_to is not None:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": record_name(refers_to), "X-Refers-To-Page": str(refers_to)}
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if refers_to is None else b"")
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "surrogatepass") + block + END


def parse(raw: bytes) -> dict:
    """Header fields of one record, and its payload under the key ``payload`` (None for a revisit)."""
    head, _, block = raw.partition(END)
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:20]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = block[:int(fields["Content-Length"])]
    return fields | {"payload": block.partition(END)[2] if fields["WARC-Type"] == "response" else None}


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Footer for frames of the given compressed and plain lengths."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file: pa.NativeFile, size: int) -> list[tuple[int, int, int]]:
    """(start, compressed length, plain length) of every frame of a bundle of ``size`` bytes."""
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * count)
    out, start = [], 0
    for packed, plain in struct.iter_unpack("<II", file.read(8 * count)):
        out.append((start, packed, plain))
        start += packed
    return out


class _Writer:
    """Writes records to bundles below a folder and yields their index rows, a bundle at a time."""

    def __init__(self, folder: str) -> None:
        self.store, self.root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        self.folder, self.packer = folder, zstandard.ZstdCompressor(level=LEVEL)
        self.file, self.frames, self.rows, self.plain, self.ids = None, [], [], bytearray(), []

    def add(self, page_id: int | None, raw: bytes) -> None:
        if self.plain and len(self.plain) + len(raw) > FRAME:
            self.end_frame()
        self.ids.append((page_id, len(self.plain), len(raw)))
        self.plain += raw

    def end_frame(self) -> None:
        if self.file is None:
            self.name = f"{uuid.uuid4().hex}.warc.zst"
            self.file = self.store.open_output_stream(f"{self.root}/{self.name}", compression=None)
            self.frames, self.written = [], 0
        packed = self.packer.compress(bytes(self.plain))
        self.file.write(packed)
        here = (f"{self.folder}/{self.name}", len(self.frames), self.written, len(packed))
        self.rows += [(page_id, *here, at, size) for page_id, at, size in self.ids]
        self.frames.append((len(packed), len(self.plain)))
        self.written += len(packed)
        self.plain, self.ids = bytearray(), []

    def end_bundle(self) -> list[tuple]:
        if self.plain:
            self.end_frame()
        if self.file is None:
            return []
        self.file.write(seek_table(self.frames))
        self.file.close()
        rows, self.rows, self.file = self.rows, [], None
        return rows


def _write(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [c.split(" ")[0] for c in INDEX.split(", ")]
    kinds = pa.schema([(n, {"bundle": pa.string(), "frame": pa.int32()}.get(n, pa.int64())) for n in names])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kinds.field(i).type) for i, c in enumerate(zip(*rows, strict=True))], schema=kinds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Writer(folder)
        for b in batches:
            for page_id, url, html, refers_to in zip(*[c.to_pylist() for c in b.columns], strict=True):
                out.add(page_id, record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers_to))
                if out.file is not None and out.written >= BUNDLE and (rows := out.end_bundle()):
                    yield batch(rows)
        if rows := out.end_bundle():
            yield batch(rows)

    return work


def referred(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html and refers_to: the response that a page's record revisits, or null.

    Only payloads that occur more than once take part in the join, with one row each.
    """
    marked = pages.select("page_id", "url", "html", F.sha1(F.coalesce("html", F.lit(""))).alias("payload"))
    long = F.octet_length(F.coalesce("html", F.lit(""))) >= least
    firsts = (
        marked.where(long).groupBy("payload").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("payload", "first")
    )
    joined = marked.join(firsts, "payload", "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & long
    return joined.select("page_id", "url", "html", F.when(other, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, folder: str, least: int = 0) -> str:
    """Write a record per row of ``pages`` (page_id, url, html) and give the path of the index table."""
    store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    store.create_dir(root, recursive=True)
    index = f"{folder}/index"
    referred(pages, least).mapInArrow(_write(folder), INDEX).write.parquet(index)
    return index


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split(" ")[0] for c in RECORDS.split(", ")]
    kinds = {"url": pa.string(), "payload": pa.binary(), "payload_digest": pa.string(), "record_type": pa.string()}
    schema = pa.schema([(n, kinds.get(n, pa.int64())) for n in names])
    unpack = zstandard.ZstdDecompressor()
    opened, file, table = None, None, []
    for b in batches:
        for bundle, frame, wanted in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if bundle != opened:
                if file is not None:
                    file.close()
                store, path = fs.FileSystem.from_uri(bundle if "://" in bundle or bundle.startswith("file:") else f"file://{bundle}")
                file, opened = store.open_input_file(path), bundle
                table = read_seek_table(file, file.size())
            start, packed, plain = table[frame]
            file.seek(start)
            raw = unpack.decompress(file.read(packed), max_output_size=plain)
            rows = []
            for at in wanted:
                fields = parse(raw[at["record_start"]:at["record_start"] + at["record_bytes"]])
                page, refers = fields["X-Page"], fields.get("X-Refers-To-Page")
                url = fields["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                if fields["payload"] is not None and f"sha1:{digest(fields['payload'])}" != fields["WARC-Payload-Digest"]:
                    raise ValueError(f"payload of page {page} in {bundle} does not match its digest")
                rows.append((int(page) if page else None, url, fields["payload"], int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"], int(refers) if refers else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    if file is not None:
        file.close()


def read(spark, index: str, wanted: DataFrame | None = None) -> DataFrame:
    """Records of an archive from its index table: all, or those with a page_id in ``wanted``.

    A revisit has its own fields and no payload; ``refers_to`` tells where the payload is. Frames are dealt in
    runs of ``TOGETHER`` of a bundle, to a number of tasks that follows from their bytes and not from those of the index.
    """
    rows = spark.read.parquet(index)
    if wanted is not None:
        rows = rows.join(wanted.select("page_id").distinct(), "page_id", "left_semi")
    frames = rows.groupBy("bundle", "frame").agg(F.array_sort(F.collect_list(F.struct("record_start", "record_bytes"))).alias("wanted"))
    total = rows.agg(F.sum("record_bytes")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK))
    runs = frames.repartition(tasks, "bundle", F.floor(F.col("frame") / TOGETHER))
    return runs.sortWithinPartitions("bundle", "frame").mapInArrow(_read, RECORDS)


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` to a fresh archive in the shared folder and read its records back."""
    spark = pages.sparkSession
    return read(spark, write(pages, fresh_path(spark, "warc"), least))
