"""Seekable Zstandard WARC bundles: writer, reader and random access.

Records are grouped into independent zstd frames; each bundle ends in a skippable frame with the seek
table of the public Zstandard seekable format (compressed and decompressed size of every frame). A
manifest table maps each record id to its bundle, frame and offset within the decompressed frame.

Records with equal payloads are stored once: the one with the smallest page id is a ``response``, the
others are ``revisit`` records that refer to it. The first of each payload comes from a grouped
minimum (partial per task), and only digests met twice or more are joined back, so that a payload
held by a third of all pages neither gathers in a task nor is stored again.

Bundles are written below a folder that all executors share, by tasks, under names of their own; the
manifest names only those of successful attempts, so a lost executor leaves at worst unused files.

Defined cases: null html is an empty payload; a null url leaves its header out; control characters in
a url or an id are percent-encoded; rows that repeat a page id are records of their own with that id, and with record ids of their own
unless their payloads are equal too (then they are one record, met twice); a null
page id gives a record that isn't named (it reads back as null) and never is the one referred to
while another has a number; extra columns are ignored; an empty table writes no bundle.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.llm.common import ready, scratch, stored

SEEKABLE_MAGIC, SKIPPABLE_MAGIC = 0x8F92EAB1, 0x184D2A5E
FRAME_BYTES, BUNDLE_BYTES = 1 << 18, 256 << 20
#: Compressed bytes that a task reads.
RANGE_BYTES = 4 << 20
NAMES = uuid.UUID("6d2f3a0e-4b7c-4f7e-9a51-0f6f5f0c9a11")

MANIFEST = ("path string, page_id string, record_type string, frame long, frame_start long, frame_bytes long, "
            "record_start long, record_bytes long")
RECORD = ("page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, "
          "payload binary")


def revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """page_id, url, payload (null for a revisit), payload_bytes, sha1 (hex) and refers_to of each page."""
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    base = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        payload.alias("payload"))
    base = base.withColumns({"sha1": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    firsts = (base.where(F.col("payload_bytes") >= min_bytes).groupBy("sha1")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select(F.col("sha1").alias("first_sha1"), "first_id"))
    out = base.join(firsts, F.col("sha1") == F.col("first_sha1"), "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return out.select("page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "payload_bytes", "sha1",
                      F.when(again, F.col("first_id")).alias("refers_to"))


def _urn(page: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page} {digest}')}>"


def _safe(text: str, also: str = "") -> str:
    """Without control characters (and those of ``also``): percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" and c not in also else f"%{ord(c):02X}" for c in text)


def _page(header: str | None) -> str | None:
    """The id that a header holds."""
    return None if header is None else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), header)


def record(page: str | None, url: str | None, payload: bytes | None, size: int, digest: str, refers: str | None,
           date: str, unnamed: str = "") -> bytes:
    """One WARC/1.1 record; ``payload`` is ignored for a revisit; ``unnamed`` tells records without an id apart."""
    urn = f"<urn:uuid:{uuid.uuid5(NAMES, unnamed)}>" if page is None else _urn(page, digest)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers is not None else 'response'}", f"WARC-Record-ID: {urn}"]
    if page is not None:
        head.append(f"X-Page-ID: {_safe(page, '%')}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_safe(url)}")
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if refers is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_urn(refers, digest)}", f"X-Refers-To-Page: {_safe(refers, '%')}"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    if refers is None:
        block += payload or b""
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def records(data: bytes) -> Iterator[dict]:
    """The records of decompressed WARC data; checks the digest of every stored payload."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC record")
        head = dict(line.split(": ", 1) for line in lines[1:])
        block = data[end + 4:end + 4 + int(head["Content-Length"])]
        at = end + 8 + len(block)
        payload = None
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response":
            payload = block[block.index(b"\r\n\r\n") + 4:]
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != int(head["X-Payload-Length"]):
                raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
        yield {"page_id": _page(head.get("X-Page-ID")), "payload_bytes": int(head["X-Payload-Length"]), "payload_digest": digest,
               "record_type": head["WARC-Type"], "refers_to": _page(head.get("X-Refers-To-Page")), "payload": payload}


class Bundle:
    """A bundle being written: frames, then the seek table."""

    def __init__(self, folder: str, task: int, level: int):
        self.uri = f"{folder}/bundle-{task:05d}-{uuid.uuid4().hex}.warc.zst"
        self.fs, self.path = pafs.FileSystem.from_uri(self.uri)
        self.fs.create_dir(posixpath.dirname(self.path), recursive=True)
        self.out = self.fs.open_output_stream(self.path, compression=None)
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.sizes: list[tuple[int, int]] = []
        self.at = 0
        self.data, self.rows = bytearray(), []

    def add(self, page: str | None, kind: str, data: bytes) -> None:
        self.rows.append((page, kind, len(self.data), len(data)))
        self.data += data

    def frame(self) -> list[tuple]:
        """Ends the frame; the manifest rows of its records."""
        if not self.rows:
            return []
        raw = self.zstd.compress(bytes(self.data))
        self.out.write(raw)
        got = [(self.uri, page, kind, len(self.sizes), self.at, len(raw), start, n) for page, kind, start, n in self.rows]
        self.sizes.append((len(raw), len(self.data)))
        self.at += len(raw)
        self.data, self.rows = bytearray(), []
        return got

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """Start, compressed and decompressed size of each frame, from the footer of an open bundle."""
    size = source.size()
    source.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC or flags & 0x80:
        raise ValueError("no seek table that this reader knows")
    source.seek(size - 9 - 8 * n)
    raw, at, out = source.read(8 * n), 0, []
    for c, d in struct.iter_unpack("<II", raw):
        out.append((at, c, d))
        at += c
    return out


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[t]) for k, (_, t) in enumerate(fields)], [n for n, _ in fields])


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", level: int = 3,
          frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes the bundles of ``pages`` below ``folder`` (a URI that all executors reach; default: a new
    folder below ``spark.checkpoint.dir``) and returns the manifest, stored beside them."""
    spark = ready(pages.sparkSession)
    folder = folder or scratch(spark, "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:"):]
    src = revisits(pages, id_col, url_col, html_col, min_bytes).withColumns(
        {"page_id": F.col("page_id").cast("string"), "refers_to": F.col("refers_to").cast("string")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bundle, ready = None, []
        for batch in batches:
            for x in batch.to_pylist():
                bundle = bundle or Bundle(folder, TaskContext.get().partitionId(), level)
                digest = base64.b32encode(bytes.fromhex(x["sha1"])).decode()
                bundle.add(x["page_id"], "response" if x["refers_to"] is None else "revisit",
                           record(x["page_id"], x["url"], x["payload"], x["payload_bytes"], digest, x["refers_to"], date,
                                  f"{bundle.uri} {len(bundle.sizes)} {len(bundle.rows)}"))
                if len(bundle.data) >= frame_bytes:
                    ready += bundle.frame()
                    if bundle.at >= bundle_bytes:
                        bundle.close()
                        bundle = None
            if ready:
                yield _batch(ready, MANIFEST)
                ready = []
        if bundle is not None:
            ready = bundle.frame()
            bundle.close()
            if ready:
                yield _batch(ready, MANIFEST)

    src.mapInArrow(run, MANIFEST).write.option("compression", "zstd").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the bundles that the manifest names, frame by frame by their seek tables; a task reads about ``range_bytes`` of one bundle."""
    ready(manifest.sparkSession)
    ranges = manifest.groupBy("path", F.floor(F.col("frame_start") / range_bytes).alias("part")).agg(F.min("frame").alias("first"), F.max("frame").alias("last"))
    ranges = stored(ranges.select("path", "first", "last"), "warc-ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdDecompressor()
        for batch in batches:
            for uri, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                fs, path = pafs.FileSystem.from_uri(uri)
                with fs.open_input_file(path) as source:
                    for start, n, size in seek_table(source)[first:last + 1]:
                        source.seek(start)
                        data = zstd.decompress(source.read(n), max_output_size=size)
                        yield _batch([tuple(r.values()) for r in records(data)], RECORD)

    # A given number of partitions: these rows are few, what they stand for isn't.
    return ranges.repartition(max(1, ranges.count())).mapInArrow(run, RECORD)


def fetch(manifest: DataFrame, wanted: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The records of the wanted page ids, each read from its own frame at its offset."""
    ready(manifest.sparkSession)
    ids = wanted.select(F.col(f"`{id_col}`").cast("string").alias("page_id")).distinct()
    rows = manifest.join(ids, "page_id", "left_semi").select("path", "frame_start", "frame_bytes", "record_start", "record_bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdDecompressor()
        for batch in batches:
            got = []
            for x in batch.to_pylist():
                fs, path = pafs.FileSystem.from_uri(x["path"])
                with fs.open_input_file(path) as source:
                    source.seek(x["frame_start"])
                    data = zstd.decompress(source.read(x["frame_bytes"]))
                got += [tuple(r.values()) for r in records(data[x["record_start"]:x["record_start"] + x["record_bytes"]])]
            if got:
                yield _batch(got, RECORD)

    return rows.mapInArrow(run, RECORD)


def archive_and_read(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes all pages and reads the archives back: one row per page, without the payload."""
    kind = pages.schema["page_id"].dataType.simpleString()
    back = read(write(pages))
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"))
