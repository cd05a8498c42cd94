"""Quality rules: base word rules and zstandard compression bands over whole texts and fixed chunks.

A text that compresses far better than prose of its length repeats itself; one that hardly
compresses holds random characters. Both are judged on the whole text and on each full chunk of
``chunk_bytes``, the last of which ends where the text ends and may overlap the one before it, with limits that depend on the length, as short texts compress worse.

Defined cases: a null or empty text has no words, fails the base rule and is not compressed
(ratio null). Texts under the first band have no ratio limits. Repeated rows are judged one by one;
extra columns of the input are ignored unless named in ``keep``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwave.llm.common import ready, encoded, slices

WINDOW = 8
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
#: Fixed random odd multipliers, one per word of a window.
MIX = np.random.default_rng(20240607).integers(1, 1 << 63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Bands:
    """Ratio limits (compressed bytes / bytes). ``whole`` rows: bytes from which the row holds, least, most."""

    whole: tuple[tuple[int, float, float], ...] = (
        (64, 0.0, 1.30), (128, 0.45, 1.00), (256, 0.42, 0.90), (512, 0.38, 0.82), (1024, 0.33, 0.75),
        (2048, 0.30, 0.72), (4096, 0.28, 0.70), (16384, 0.25, 0.68))
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (0.28, 0.72)
    level: int = 3


def word_measures(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    n = len(texts)
    words = [t.split() for t in texts]          # bytes.split(): exactly space and 0x09-0x0D
    counts = np.fromiter(map(len, words), np.int64, n)
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, n) + 1)
    starts = ends - np.fromiter(map(len, texts), np.int64, n) - 1
    points = np.concatenate([[0], np.cumsum(~SPACE[joined] & ((joined & 0xC0) != 0x80))])
    symbols = np.concatenate([[0], np.cumsum(SYMBOL[joined])])
    dup = np.zeros(n, np.int64)
    for k, t in enumerate(texts):
        lines = [x for x in t.split(b"\n") if x and not x.isspace()]
        dup[k] = len(lines) - len(set(lines))
    return {"n_words": counts, "word_chars": points[ends] - points[starts], "n_symbols": symbols[ends] - symbols[starts],
            "n_dup_lines": dup, "n_repeat_words": repeat_words(words, counts)}


def repeat_words(words: list[list[bytes]], counts: np.ndarray) -> np.ndarray:
    """Words covered by 8-word windows that the text holds twice or more."""
    out, total = np.zeros(len(words), np.int64), int(counts.sum())
    if total < WINDOW + 1:
        return out
    flat = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.uint64)
    doc = np.repeat(np.arange(len(words)), counts)
    m = total - WINDOW + 1
    at = np.flatnonzero(doc[:m] == doc[WINDOW - 1:])
    if not len(at):
        return out
    mixed = (flat + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    key = (doc[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(WINDOW):
        key += mixed[at + k] * MIX[k]
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    if not len(same):
        return out
    a, b = at[order[same]], at[order[same + 1]]
    equal = doc[a] == doc[b]
    for k in range(WINDOW):
        equal &= flat[a + k] == flat[b + k]
    if not equal.all():                         # two windows share a hash: group these by their words
        found: dict[tuple, list[int]] = {}
        for i in np.unique(np.concatenate([a, b])).tolist():
            found.setdefault((doc[i], *flat[i:i + WINDOW].tolist()), []).append(i)
        hits = np.array([i for v in found.values() if len(v) > 1 for i in v], np.int64)
    else:
        hits = np.concatenate([a, b])
    edge = np.zeros(total + 1, np.int64)
    hits = np.unique(hits)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + WINDOW, -1)
    return np.bincount(doc, weights=np.cumsum(edge[:-1]) > 0, minlength=len(words)).astype(np.int64)


def ratios(text: bytes, bands: Bands, zstd: zstandard.ZstdCompressor) -> tuple[float | None, float | None, float | None, bool]:
    """Ratio of the whole text, least and most ratio of its full chunks, and whether all keep the limits."""
    n = len(text)
    if not n:
        return None, None, None, True
    whole = len(zstd.compress(text)) / n
    c = bands.chunk_bytes
    starts = [*range(0, n - c + 1, c), *([n - c] if n > c and n % c else [])]
    parts = [len(zstd.compress(text[i:i + c])) / c for i in starts]
    limits = [row for row in bands.whole if row[0] <= n]
    good = not limits or limits[-1][1] <= whole <= limits[-1][2]
    if parts:
        good = good and bands.chunk[0] <= min(parts) and max(parts) <= bands.chunk[1]
    return whole, min(parts, default=None), max(parts, default=None), good


OUT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
       "whole_ratio double, least_chunk_ratio double, most_chunk_ratio double, kept boolean")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
          bands: Bands = Bands(), min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """``id_col``, the ``keep`` columns, the measures, ``base_failed`` and ``kept`` for every row."""
    ready(docs.sparkSession)
    names = [id_col, *(c for c in keep if c not in (id_col,))]
    src = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]) + ", " + OUT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=bands.level)
        for part in slices(batches, "__text"):
            texts = encoded(part, "__text")
            got = word_measures(texts)
            failed = (got["n_words"] < min_words) | (100 * got["n_repeat_words"] > max_repeat_percent * got["n_words"])
            bands_of = [ratios(t, bands, zstd) for t in texts]
            good = np.array([x[3] for x in bands_of], bool)
            cols = [part.column(k) for k in range(len(names))] + [pa.array(v) for v in got.values()]
            cols += [pa.array(failed)] + [pa.array([x[k] for x in bands_of], pa.float64()) for k in range(3)]
            cols.append(pa.array(~failed & good))
            yield pa.RecordBatch.from_arrays(cols, names + [x.split()[0] for x in OUT.split(", ")])

    return src.mapInArrow(run, schema)


def filter_stage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, whatever their names (pipeline stage)."""
    names = docs.columns
    held = {c: f"__column{k}" for k, c in enumerate(names)}
    judged = judge(docs.select(*[F.col(f"`{c}`").alias(h) for c, h in held.items()]), held[id_col], held[text_col],
                   tuple(held.values()), **options)
    return judged.where("kept").select(*[F.col(h).alias(c) for c, h in held.items()])
