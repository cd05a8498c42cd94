"""Blocks: runs of documents packed into single rows, so that whole-corpus counts move as arrays.

A block holds the ids, digests and zstd-compressed texts of consecutive documents, about
``block_bytes`` of text (one document at least). Blocks are written once; later passes read them, join
them by their number with what other tasks found out for them, and see the same documents in the same order.

Keys that all blocks count together (shingles, n-grams) go as sorted arrays to ``n_buckets`` buckets by
their top bits: each block sends each bucket one row, a bucket merges the rows of all blocks and answers
each block with values for its own keys. A key met in a third of all documents is one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwave.llm.common import ready, slices, stored

BLOCK_BYTES = 4 << 20
#: Entries that a bucket is meant to hold.
BUCKET_KEYS = 3_000_000


def pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def unpack(raw: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys by their differences, low bytes kept apart from the others so that zeros compress."""
    if not len(keys):
        return b""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return pack(gaps.T)


def unpack_sorted(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    planes = unpack(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build(docs: DataFrame, id_col: str, text_col: str, name: str, extra: dict[str, Column] | None = None,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The stored table of blocks: block, ids, digests (sha256 of the text; null as empty), sizes, data and a list of each ``extra`` column."""
    ready(docs.sparkSession)
    extra = extra or {}
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
                      *[c.alias(k) for k, c in extra.items()], text.alias("__text"))
    types = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    schema = (f"block long, ids array<{types['id']}>, digests array<binary>, "
              + "".join(f"`{k}` array<{types[k]}>, " for k in extra) + "sizes binary, data binary")

    more = list(extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        held: list[pa.RecordBatch] = []
        size = 0

        def block() -> pa.RecordBatch:
            part = pa.Table.from_batches(held).combine_chunks()
            cols = [part.column(k).combine_chunks() if part.num_rows else part.column(k) for k in range(part.num_columns)]
            cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols]
            raw = [t.encode("utf-8", "surrogatepass") for t in cols[-1].to_pylist()]
            lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), c) for c in cols[:-1]]
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(raw))
            number = uuid.uuid4().int >> 65
            return pa.RecordBatch.from_arrays([pa.array([number]), *lists, pa.array([pack(np.array([len(x) for x in raw], np.int64))], pa.binary()),
                                               pa.array([data], pa.binary())], ["block", "ids", "digests", *more, "sizes", "data"])

        for part in slices(batches, "__text", block_bytes // 2):
            n = part.column(part.num_columns - 1).nbytes
            if held and size + n > block_bytes:
                yield block()
                held, size = [], 0
            held.append(part)
            size += n
        if held:
            yield block()

    return stored(src.mapInArrow(run, schema), name)


def texts(sizes: bytes, data: bytes) -> list[bytes]:
    """The UTF-8 texts of a block."""
    lengths = unpack(sizes, np.int64)
    raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=int(lengths.sum()) + 1) if len(lengths) else b""
    ends = np.cumsum(lengths)
    return [raw[e - n:e] for e, n in zip(ends.tolist(), lengths.tolist())]


def bucket_bits(n_blocks: int, block_keys: int = 800_000, least: int = 6) -> int:
    """Bits of a key that name its bucket, so that a bucket's entries stay few however many blocks there are."""
    return max(least, int(np.ceil(np.log2(max(1, n_blocks * block_keys / BUCKET_KEYS)))))


def cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket's keys begin among sorted keys, and the end."""
    edges = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
