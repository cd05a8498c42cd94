"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model file is read directly (pieces, scores, kinds, normaliser). A text becomes segments between
which no piece can reach: words with their leading blanks, and line ends. All new segments of a slice
are merged together: symbols lie in flat numpy arrays, each round finds the least pair rank of each
segment, merges it simultaneously in all segments, and compacts, until no pair is left. Of one
segment all leftmost non-overlapping occurrences of the best pair merge at once where that equals
merging them one by one (no longer piece built from the result ranks before or beside it), else
only the leftmost does. Segments repeat, so their ids are kept in a bounded table per worker.

Supported: BPE models with the identity normaliser (with or without dummy prefix) and byte fallback
or an unknown id; others raise ValueError.

Defined cases: null and empty texts give the end id alone and decode to the empty text; repeated rows
are encoded one by one; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwave.llm.common import ready, slices

BLANK = "▁"
NONE = np.int32(2**31 - 1)
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Segments kept per worker before the table starts anew.
KEPT_SEGMENTS = 400_000


def _varint(b: bytes, i: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        out |= (b[i] & 127) << shift
        shift += 7
        i += 1
        if b[i - 1] < 128:
            return out, i


def _fields(b: bytes) -> Iterator[tuple[int, object]]:
    """Field number and raw value of each field of a protocol buffer message."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(b, i)
        else:
            n = {1: 8, 5: 4}.get(kind)
            if n is None:
                n, i = _varint(b, i)
            value, i = b[i:i + n], i + n
        yield key >> 3, value


class Model:
    """Pieces, the table of pairs that merge, and the decoding table of a BPE model."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            raw = f.read()
        pieces, trainer, normal = [], {}, {}
        for number, value in _fields(raw):
            if number == 1:
                got = dict(_fields(value))
                pieces.append((got[1].decode(), struct.unpack("<f", got.get(2, b"\0" * 4))[0], got.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        if (trainer.get(3, 1) != 2 or normal.get(1) != b"identity" or normal.get(2) or normal.get(4, 1) or not normal.get(5, 1)
                or trainer.get(24, 0) or any(k in (USER, UNUSED) for _, _, k in pieces)):
            raise ValueError("only BPE models with the identity normaliser and plain pieces are supported")
        self.dummy = bool(normal.get(3, 1))
        self.unk = next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN)
        self.end = next((i for i, p in enumerate(pieces) if p[2] == CONTROL and p[0] == "</s>"), None)
        self.pieces = pieces
        self.bytes_at = {int(p[0][3:5], 16): i for i, p in enumerate(pieces) if p[2] == BYTE} if trainer.get(35) else {}
        self.ids = {p[0]: i for i, p in enumerate(pieces) if p[2] == NORMAL}
        scores = sorted({pieces[i][1] for i in self.ids.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        # Symbols: piece ids, then single characters that only occur inside pieces.
        self.symbols = dict(self.ids)
        for piece in self.ids:
            for c in piece:
                self.symbols.setdefault(c, len(pieces) + len(self.symbols))
        self.rank = {i: rank_of[pieces[i][1]] for i in self.ids.values()}
        left, right, to = [], [], []
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                a, b = self.symbols.get(piece[:k]), self.symbols.get(piece[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), to.append(i)
        self.n_symbols = max(self.symbols.values(), default=0) + 2
        a, b, to = (np.array(x, np.int64) for x in (left, right, to))
        rank = np.array([self.rank[int(i)] for i in to], np.int64)
        best = np.full(self.n_symbols, NONE, np.int64)      # rank of the best piece that each symbol is a direct part of
        np.minimum.at(best, a, rank)
        np.minimum.at(best, b, rank)
        of = np.full(self.n_symbols, -1, np.int64)
        of[list(self.rank)] = list(self.rank.values())
        self.safe = best > of
        self._build(a * self.n_symbols + b, to, rank)
        self.of_char = np.full(0x110000, self.n_symbols - 1, np.int32)    # the last symbol merges with nothing
        for text, i in self.symbols.items():
            if len(text) == 1:
                self.of_char[ord(text)] = i
        self.numbers = np.array([str(i) for i in range(len(pieces))], object)
        # For decoding, by decimal id: the text of pieces other than bytes; bytes; ids that have no text.
        self.text_of = {str(i): " \u2047 " if k == UNKNOWN else "" if k == CONTROL else p.replace(BLANK, " ") for i, (p, _, k) in enumerate(pieces) if k != BYTE}
        self.byte_of = {str(i): int(p[3:5], 16) for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.silent = {str(i) for i, (_, _, k) in enumerate(pieces) if k == CONTROL}
        self.blank_first = {str(i) for i, (p, _, k) in enumerate(pieces) if k == NORMAL and p[:1] == BLANK}
        tall = [p for p in self.ids if len(p) > 1]
        self.line_cuts = self.dummy and not any("\n" in p for p in tall)
        self.word_cuts = not any(BLANK in p.lstrip(BLANK) for p in tall)
        self.blank_run = self._blank_run()

    def _blank_run(self) -> int:
        """K if a run of more than K blanks always becomes a piece of K blanks and the run without it.

        True where pieces of blanks alone rank after all others (so they merge last, with what blanks
        the others left) and, of lengths up to 4 K, each run does so."""
        runs = [len(p) for p in self.ids if len(p) > 1 and not p.strip(BLANK)]
        rest = max((self.rank[i] for p, i in self.ids.items() if len(p) > 1 and p.strip(BLANK)), default=-1)
        if not runs or BLANK not in self.ids or min(self.rank[self.ids[BLANK * n]] for n in runs) <= rest:
            return 0
        k = max(runs)
        own = [""] + self.merge([BLANK * n for n in range(1, 4 * k + 1)])
        block = str(self.ids[BLANK * k])
        return k if all(own[n] == f"{block} {own[n - k]}" for n in range(k + 1, 4 * k + 1)) else 0

    def _build(self, keys: np.ndarray, to: np.ndarray, rank: np.ndarray) -> None:
        """An open-addressing table from pair to piece and rank."""
        bits = max(10, int(np.ceil(np.log2(len(keys) * 8 + 1))))
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.keys = np.full(size, -1, np.int64)
        self.to, self.to_rank = np.zeros(size, np.int32), np.full(size, NONE, np.int32)
        slots = self._slot(keys)
        self.probes = 1
        for key, slot, t, r in zip(keys.tolist(), slots.tolist(), to.tolist(), rank.tolist()):
            n = 1
            while self.keys[slot] != -1:
                slot, n = (slot + 1) % size, n + 1
            self.keys[slot], self.to[slot], self.to_rank[slot] = key, t, r
            self.probes = max(self.probes, n)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and rank of each pair (rank NONE: they don't merge)."""
        keys = a.astype(np.int64) * self.n_symbols + b
        slot = self._slot(keys)
        at = self.keys[slot]
        hit = at == keys
        open_ = np.flatnonzero(~hit & (at != -1))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) % len(self.keys)
            at = self.keys[slot[open_]]
            hit[open_] = at == keys[open_]
            open_ = open_[~hit[open_] & (at != -1)]
        return np.where(hit, self.to[slot], 0), np.where(hit, self.to_rank[slot], NONE)

    def merge(self, segments: list[str]) -> list[str]:
        """Ids (decimal, joined by blanks) of each segment (not empty), merged in common rounds."""
        if not segments:
            return []
        flat = "".join(segments)
        sym = self.of_char[np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        word = np.repeat(np.arange(len(segments)), lengths)
        char = np.arange(len(flat))                        # where each symbol starts in flat
        out_word, out_sym, out_char = [], [], []
        while len(sym):
            to, rank = self.pairs(sym[:-1], sym[1:])
            rank[word[:-1] != word[1:]] = NONE
            rank = np.append(rank, NONE)
            begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.append(begins, len(word)))
            done = np.repeat(least == NONE, sizes)
            if done.any():
                out_word.append(word[done]), out_sym.append(sym[done]), out_char.append(char[done])
                go = ~done
                if not go.any():
                    break
                to, rank = np.append(to, 0)[go], rank[go]
                sym, word, char = sym[go], word[go], char[go]
                least, sizes = least[least != NONE], sizes[least != NONE]
            else:
                to = np.append(to, 0)
            hit = np.flatnonzero(rank == np.repeat(least, sizes))
            first = np.append(True, word[hit[1:]] != word[hit[:-1]])
            follows = np.append(False, (hit[1:] == hit[:-1] + 1) & ~first[1:])
            run = np.maximum.accumulate(np.where(follows, -1, np.arange(len(hit))))
            even = (np.arange(len(hit)) - run) % 2 == 0    # of overlapping occurrences every other one, from the left
            hit = hit[np.where(self.safe[to[hit]], even, first)]
            sym[hit] = to[hit]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            sym, word, char = sym[stay], word[stay], char[stay]
        sym, char = np.concatenate(out_sym), np.concatenate(out_char)
        order = np.argsort(char)
        sym, char = sym[order], char[order]
        word = np.concatenate(out_word)[order]
        rare = np.flatnonzero(sym >= len(self.pieces))
        sym[rare] = self.unk
        numbers = self.numbers[sym].tolist()
        for i, c in zip(rare.tolist(), char[rare].tolist()):
            if self.bytes_at:
                numbers[i] = " ".join(str(self.bytes_at[x]) for x in flat[c].encode())
            elif i and word[i - 1] == word[i] and numbers[i - 1] in ("", str(self.unk)):
                numbers[i] = ""                            # neighbouring unknown characters are one id
        bounds = np.append(np.flatnonzero(np.append(True, word[1:] != word[:-1])), len(word)).tolist()
        edges = list(zip(bounds, bounds[1:]))
        ids = [" ".join(numbers[a:b]) for a, b in edges]
        if not self.bytes_at and len(rare):
            ids = [" ".join(x.split()) for x in ids]
        return ids

    def decode(self, ids: list[str]) -> str:
        """The text of decimal ids: pieces with their blanks, runs of bytes as UTF-8, control ids as nothing, the unknown id as its mark; the blank
        that the dummy prefix put before the first piece goes."""
        if self.byte_of and not self.byte_of.keys().isdisjoint(ids):
            out, raw = [], bytearray()
            for i in ids:
                if i in self.byte_of:
                    raw.append(self.byte_of[i])
                    continue
                if raw:
                    out.append(_lossy(bytes(raw)))
                    raw = bytearray()
                out.append(self.text_of[i])
            text = "".join(out) + _lossy(bytes(raw))
        else:
            text = "".join(map(self.text_of.__getitem__, ids))
        first = next((i for i in ids if i not in self.silent), None)
        return text[1:] if self.dummy and first in self.blank_first else text


def _lossy(raw: bytes) -> str:
    """UTF-8 with one replacement character for each byte that isn't part of a valid character."""
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[:e.start].decode() + "�")
            raw = raw[e.start + 1:]
    return "".join(out)


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


class Coder:
    """Encodes and decodes whole texts, keeping the segments it has met (bounded).

    Segments are known by keys: a word after one blank by itself, a line end by itself, any other
    segment with the mark before it."""

    MARK = "\x01"

    def __init__(self, model: Model, kept: int = KEPT_SEGMENTS):
        if not model.word_cuts:
            raise ValueError("a piece holds a blank after another character: words can't be cut apart")
        self.model, self.kept = model, kept
        self.known: dict[str, str] = {}         # key to ids
        self.run = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.odd = (BLANK, self.MARK, "  ", "\n ", " \n")

    def keys(self, text: str) -> list[str]:
        """The keys of the text's segments, in order."""
        if self.model.line_cuts and text[0] != " " and text[-1] != " " and not any(x in text for x in self.odd):
            if text[0] == "\n":
                return [self.MARK + BLANK, *(k for k in text.replace("\n", f" \n {self.MARK}").split(" ") if k and k != self.MARK)]
            got = text.replace("\n", f" \n {self.MARK}").split(" ")
            return [k for k in got if k != self.MARK] if self.MARK in got else got
        out, m = [], self.model
        for k, line in enumerate(text.split("\n") if m.line_cuts else [text]):
            if k:
                out.append("\n")
            line = (BLANK if k == 0 and m.dummy else "") + line.replace(" ", BLANK)
            out += [self.MARK + part for segment in self.run.findall(line) for part in self.cut(segment)]
        return out

    def cut(self, segment: str) -> list[str]:
        """Whole runs of blanks that can only become pieces of their own go before the rest."""
        k = self.model.blank_run
        blanks = len(segment) - len(segment.lstrip(BLANK)) if k else 0
        n = (blanks - 1) // k if k and blanks > k else 0
        return [BLANK * k] * n + [segment[n * k:]]

    def segment(self, key: str) -> str:
        return key[1:] if key[0] == self.MARK else key if key == "\n" and self.model.line_cuts else BLANK + key

    def encode(self, texts: list[str]) -> list[list[str]]:
        """For each text its segments' ids, as strings of decimal ids."""
        if len(self.known) > self.kept:
            self.known = {}
        flat: list[str] = []
        ends = [0]
        for t in texts:
            if t:
                flat += self.keys(t)
            ends.append(len(flat))
        new = list(set(flat).difference(self.known))
        if new:
            self.known.update(zip(new, self.model.merge([self.segment(k) for k in new])))
        got = list(map(self.known.__getitem__, flat))
        return [got[a:b] for a, b in zip(ends, ends[1:])]


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                  keep: tuple[str, ...] = (), with_ids: bool = False, with_text: bool = False,
                  digests: bool = True) -> DataFrame:
    """Every text's ids (an end id last) and the text that they decode to, as lists, texts or digests.

    Columns: ``id_col``, the ``keep`` columns, ``n_tokens``, with ``digests`` ``ids_sha256`` and
    ``decoded_sha256``, with ``with_ids`` ``ids`` (array<int>), with ``with_text`` ``decoded``."""
    ready(docs.sparkSession)
    names = [id_col, *(c for c in keep if c != id_col)]
    src = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`").cast("string").alias("__text"))
    tail = ["n_tokens long"] + ["ids_sha256 string", "decoded_sha256 string"] * digests + ["ids array<int>"] * with_ids + ["decoded string"] * with_text
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]] + tail)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(load(model_path))
        end = [] if coder.model.end is None else [str(coder.model.end)]
        for part in slices(batches, "__text"):
            texts = [t or "" for t in part.column(len(names)).to_pylist()]
            n, ids_hex, text_hex, all_ids, decoded = [], [], [], [], []
            for segments in coder.encode(texts):
                joined = " ".join(segments + end)
                n.append(joined.count(" ") + bool(joined))
                if digests or with_text:
                    text = coder.model.decode(joined.split(" ")) if joined else ""
                if digests:
                    ids_hex.append(hashlib.sha256(joined.encode()).hexdigest())
                    text_hex.append(hashlib.sha256(text.encode()).hexdigest())
                if with_ids:
                    all_ids.append(np.array(joined.split(), np.int32))
                if with_text:
                    decoded.append(text)
            cols = [part.column(k) for k in range(len(names))] + [pa.array(n, pa.int64())]
            cols += [pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())] * digests
            cols += [pa.array(all_ids, pa.list_(pa.int32()))] * with_ids + [pa.array(decoded, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays(cols, names + [x.split()[0] for x in tail])

    return src.mapInArrow(run, schema)
