"""Line dedup by content-defined chunks of lines.

Each text's lines that aren't blank are hashed. A rolling hash over the last ``ROLL`` line hashes chooses where a chunk of lines ends, so the same lines are cut alike
wherever they stand, some lines after the begin of a passage. Chunks of two lines and ``CHUNK_WORDS`` words or more that occur more than once anywhere are repeated: the first
occurrence (smallest document id, then text hash, then place) stays, the lines of the others go.

Two things make sure that no passage is missed because boundaries fall badly. Besides chunks, anchors are, from each line on, the shortest run of two lines or more with
``LEAST_WORDS`` words, and single lines of ``LONG_WORDS`` words: so every repeated passage of that size is met. And each repeated anchor is extended: lines beside an occurrence
that equal, one after the other, the lines beside the occurrence that stays, go too (what is left at a passage's ends has fewer than ``LEAST_WORDS`` words). Short
lines that many texts share (answers, closing brackets) are no anchor by themselves and stay.

A line goes only for an equal line at a smaller place, so every line's text survives once. What has the same hash is compared byte by byte: for each hash the least and
the greatest bytes (found per task first) must be equal, else all with this hash stay.

Scale: hashes and places move, no text: lines as one packed row per document, chunks as rows counted by partial sums. A chunk that
a third of all documents hold is one row per task before the shuffle; the joins of occurrences with the repeated hashes may be split by Spark, as they are plain equi-joins with one row per
hash on one side. The documents are joined once, with their spans.

Defined cases: null texts stay null; blank lines are no part of chunks and stay, but for those within a removed span; a
text of one line has no chunk but a long line; rows that repeat a document's id and text are one document and are treated
alike; repeats within one document go too; a null id counts as the smallest; extra columns pass through; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwave.llm.common import ready, release, slices, stored

#: Words from which a single line, a run of lines and a chunk are anchors.
LONG_WORDS, LEAST_WORDS, CHUNK_WORDS = 50, 20, 10
#: Lines that the rolling hash sees; one in so many of its values ends a chunk; lines of a chunk at least and at most.
ROLL, GAP, MIN_LINES, MAX_LINES = 2, 3, 2, 16
MASK, MUL, MIX = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
WIDTH = 16


def line_table(text: str) -> tuple[bytes, list[int]]:
    """Digests of the lines that aren't blank, one after the other, and their words."""
    digests, words = [], []
    for x in text.split("\n"):
        if n := len(x.split()):
            digests.append(xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")))
            words.append(n)
    return b"".join(digests), words


def boundaries(digests: bytes, n: int) -> list[int]:
    """Ends of the chunks of n lines (line after the last), by a rolling hash over ``ROLL`` line hashes."""
    own = [int.from_bytes(digests[k * WIDTH:k * WIDTH + 8], "little") for k in range(n)]
    out, begin, rolling, oldest = [], 0, 0, pow(MUL, ROLL, 1 << 64)
    for k in range(n):
        rolling = (rolling * MUL + own[k] - (own[k - ROLL] * oldest if k >= ROLL else 0)) & MASK
        size = k + 1 - begin
        if size >= MIN_LINES and ((rolling * MIX & MASK) >> 32) % GAP == 0 or size >= MAX_LINES or k == n - 1:
            out.append(k + 1)
            begin = k + 1
    return out


def anchors(digests: bytes, words: list[int]) -> list[tuple[int, int, bytes]]:
    """First line, line after the last (among lines that aren't blank) and hash of each chunk, run of words and long line."""
    n = len(words)
    total = np.concatenate([[0], np.cumsum(words)]).tolist()
    spans, begin = set(), 0
    for end in boundaries(digests, n):
        if end - begin >= MIN_LINES and total[end] - total[begin] >= CHUNK_WORDS:
            spans.add((begin, end))
        begin = end
    end = 0
    for k in range(n):
        while end < n and (total[end] - total[k] < LEAST_WORDS or end - k < MIN_LINES):
            end += 1
        if total[end] - total[k] < LEAST_WORDS or end - k < MIN_LINES:
            break
        spans.add((k, end))
    spans.update((k, k + 1) for k in range(n) if words[k] >= LONG_WORDS)
    return [(a, b, xxhash.xxh3_128_digest(digests[a * WIDTH:b * WIDTH])) for a, b in sorted(spans)]


def line_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, digests, words of each document's lines, stored."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("text_hash"),
                      F.col(f"`{text_col}`").cast("string").alias("__text")).where("__text is not null")
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            found = [line_table(t) for t in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([f[0] for f in found], pa.binary()),
                                              pa.array([f[1] for f in found], pa.list_(pa.int32()))], ["doc_id", "text_hash", "digests", "words"])

    return stored(src.mapInArrow(run, f"doc_id {kind}, text_hash long, digests binary, words array<int>"), "lines")


def chunk_rows(lines: DataFrame) -> DataFrame:
    """doc_id, text_hash, first, after (among lines that aren't blank), h of each anchor of each document."""
    kind = lines.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [anchors(d, w) for d, w in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            take = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            flat = [c for f in found for c in f]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array([c[0] for c in flat], pa.int32()),
                 pa.array([c[1] for c in flat], pa.int32()), pa.array([c[2] for c in flat], pa.binary())],
                ["doc_id", "text_hash", "first", "after", "h"])

    return lines.select("doc_id", "text_hash", "digests", "words").mapInArrow(run, f"doc_id {kind}, text_hash long, first int, after int, h binary")


def _beside(marked: DataFrame) -> DataFrame:
    """h, keep, side, doc_id, text_hash, at, digests: the lines beside occurrences of repeated anchors, nearest first, up to ``LEAST_WORDS`` words.

    Of occurrences that go, only those at the edge of what goes; of those that stay, all."""
    kind = marked.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for i, (digests, words, spans) in enumerate(zip(*(b.column(c).to_pylist() for c in (2, 3, 4)))):
                gone = np.zeros(len(words) + 2, bool)                 # one place before the first line, one after the last
                for s in spans:
                    if not s["keep"]:
                        gone[s["first"] + 1:s["after"] + 1] = True
                for s in spans:
                    for side, edge, step in ((0, s["first"] - 1, -1), (1, s["after"], 1)):
                        if not s["keep"] and gone[edge + 1]:
                            continue
                        k, n, some = edge, 0, []
                        while 0 <= k < len(words) and n < LEAST_WORDS and (s["keep"] or not gone[k + 1]):
                            n += words[k]
                            some.append(k)
                            k += step
                        if some:
                            rows.append((s["h"], s["keep"], side, i, some, b"".join(digests[k * WIDTH:(k + 1) * WIDTH] for k in some)))
            take = pa.array([r[3] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.int32()),
                 b.column(0).take(take), b.column(1).take(take), pa.array([r[4] for r in rows], pa.list_(pa.int32())), pa.array([r[5] for r in rows], pa.binary())],
                ["h", "keep", "side", "doc_id", "text_hash", "at", "digests"])

    return marked.mapInArrow(run, f"h binary, keep boolean, side int, doc_id {kind}, text_hash long, at array<int>, digests binary")


def extensions(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, text_hash, span: single lines beside occurrences that equal, one after the other, those beside the occurrence that stays
    (keep: these lines, for the comparison of bytes)."""
    per = spans.groupBy("doc_id", "text_hash").agg(F.collect_set("span").alias("spans")).withColumnsRenamed({"doc_id": "d", "text_hash": "t"})
    one = lines.dropDuplicates(["doc_id", "text_hash"])
    marked = one.join(per, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))).select("doc_id", "text_hash", "digests", "words", "spans")
    beside = stored(_beside(marked), "lines-beside")
    stay = beside.where("keep").select(F.col("h").alias("kh"), F.col("side").alias("ks"), F.col("doc_id").alias("kd"), F.col("text_hash").alias("kt"),
                                       F.col("at").alias("kat"), F.col("digests").alias("kdig"))
    both = beside.where("NOT keep").join(stay, (F.col("h") == F.col("kh")) & (F.col("side") == F.col("ks")))
    n = F.expr(f"size(filter(sequence(1, least(size(at), size(kat))), i -> substring(digests, 1, {WIDTH} * i) = substring(kdig, 1, {WIDTH} * i)))")
    met = both.withColumn("n", n).where("n > 0")
    span = lambda at, digests, keep: F.explode(F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.struct(
        F.get(at, i - 1).alias("first"), (F.get(at, i - 1) + 1).alias("after"), F.substring(digests, (i - 1) * WIDTH + 1, F.lit(WIDTH)).alias("h"),
        F.lit(keep).alias("keep")))).alias("span")
    goes = met.select("doc_id", "text_hash", span("at", "digests", False))
    stays = met.select(F.col("kd").alias("doc_id"), F.col("kt").alias("text_hash"), span("kat", "kdig", True))
    return goes.unionByName(stays)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their repeated lines: all columns of ``docs`` and ``__spans``, an array of (first, after, h, keep) among
    the lines that aren't blank; null where a document has none."""
    lines = line_rows(docs, id_col, text_col)
    rows = chunk_rows(lines)
    place = F.struct(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), F.col("first").alias("f"))
    # Rows that repeat an id and text give equal places: they count as one occurrence.
    counted = (rows.groupBy("h").agg(F.min(place).alias("lowest"), F.max(place).alias("highest"))
               .where("lowest <> highest").select(F.col("h").alias("rh"), "lowest"))
    spans = stored(rows.join(counted, F.col("h") == F.col("rh"))
                   .select("doc_id", "text_hash", F.struct("first", "after", "h", place.eqNullSafe(F.col("lowest")).alias("keep")).alias("span")), "lines-spans")
    release(docs.sparkSession)
    every = spans.unionByName(extensions(lines, spans))
    per = every.groupBy("doc_id", "text_hash").agg(F.collect_set("span").alias("__spans")).withColumnsRenamed({"doc_id": "__d", "text_hash": "__t"})
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__d")) & (F.xxhash64(F.col(f"`{text_col}`").cast("string")) == F.col("__t"))
    return docs.join(per, same, "left").drop("__d", "__t")


def unequal(marked: DataFrame, text_col: str) -> DataFrame:
    """Hashes that stand for different bytes."""
    src = marked.where("__spans is not null").select(F.col(f"`{text_col}`").cast("string").alias("__text"), "__spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            hs, texts = [], []
            for text, spans in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                lines = [x for x in text.split("\n") if x and not x.isspace()]
                for s in spans:
                    hs.append(s["h"])
                    texts.append("\n".join(lines[s["first"]:s["after"]]).encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array(hs, pa.binary()), pa.array(texts, pa.binary())], ["h", "chunk"])

    return (src.mapInArrow(run, "h binary, chunk binary").groupBy("h").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
            .where("low <> high").select("h"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the text without repeated chunks, and ``__removed`` (number of lines removed)."""
    ready(docs.sparkSession)
    names = docs.columns
    marked = stored(repeats(docs, id_col, text_col), "lines-marked")
    release(docs.sparkSession)
    bad = stored(unequal(marked, text_col), "lines-unequal")
    if not bad.isEmpty():
        # Chunks of a hash that stands for different bytes stay: take these spans out before the rewrite.
        spans = (marked.where("__spans is not null").select(F.col(f"`{id_col}`").alias("__d"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("__t"), F.explode("__spans").alias("span"))
                 .join(bad.withColumnRenamed("h", "bh"), F.col("span.h") == F.col("bh"), "left_anti").groupBy("__d", "__t").agg(F.collect_set("span").alias("__good")))
        same = F.col(f"`{id_col}`").eqNullSafe(F.col("__d")) & (F.xxhash64(F.col(f"`{text_col}`").cast("string")) == F.col("__t"))
        marked = marked.join(spans, same, "left").drop("__d", "__t", "__spans").withColumnRenamed("__good", "__spans")
    held = {c: f"__column{k}" for k, c in enumerate(names) if c != text_col}
    order = list(held.values())
    src = marked.select(*[F.col(f"`{c}`").alias(h) for c, h in held.items()], F.col(f"`{text_col}`").cast("string").alias("__text"),
                        F.transform(F.filter("__spans", lambda s: ~s["keep"]), lambda s: F.struct(s["first"], s["after"])).alias("__cut"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-2]) + ", __text string, __removed long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            texts, removed = [], []
            n = len(order)
            for text, cut in zip(part.column(n).to_pylist(), part.column(n + 1).to_pylist()):
                gone = 0
                if cut and text is not None:
                    lines = text.split("\n")
                    at = [k for k, x in enumerate(lines) if x and not x.isspace()]
                    goes = np.zeros(len(at) + 1, bool)
                    for s in cut:
                        first, after = s.values()
                        goes[first:after] = True
                    out = np.zeros(len(lines), bool)
                    for k in np.flatnonzero(goes[:-1]).tolist():
                        # Blank lines between two lines that go, go as well.
                        out[at[k]:at[k + 1] if goes[k + 1] else at[k] + 1] = True
                    gone = int(out.sum())
                    text = "\n".join(x for x, o in zip(lines, out.tolist()) if not o)
                texts.append(text)
                removed.append(gone)
            yield pa.RecordBatch.from_arrays([part.column(k) for k in range(n)] + [pa.array(texts, pa.string()), pa.array(removed, pa.int64())],
                                             order + ["__text", "__removed"])

    done = src.mapInArrow(run, schema)
    return done.select(*[F.col(held.get(c, "__text")).alias(c) for c in names], "__removed")


def dedup_stage(docs: DataFrame) -> DataFrame:
    """``docs`` with its texts deduplicated, all rows and columns (pipeline stage)."""
    return dedup(docs).drop("__removed")
