"""Katz backoff language model: Good-Turing discounts, exactly normalised backoff weights, scores of every token.

A token's probability after history h is ``d(c) c(h, w) / c(h)`` where the pair was seen, else
``alpha(h)`` times its probability after the shorter history, down to single words; unseen words share
what discounts take from single words. ``alpha(h)`` is what the seen words leave, divided by what the
shorter history leaves for unseen words, so that all known words and the one unknown word sum to 1.

Discounts are Katz's for counts up to ``K``; where counts of counts give no valid ones (small corpora),
absolute discounts with ``n1 / (n1 + 2 n2)`` take their place. A history that no discount touches keeps ``1 / (c(h) + 1)``
for unseen words.

The corpus is packed into blocks. Each level counts unique n-grams per block, sends them as sorted arrays
to buckets by history, stores the merged table (a table per level, one row per bucket), and answers each
block with the counts and backoff weights of its own n-grams only. Histories with so many occurrences that they
would fill a bucket are split over several by word, and only their sums are put together again.

Single words are known by 64-bit hashes; longer n-grams by the numbers of their parts, exactly.

Defined cases: null and empty texts are the end token alone; a null id trains; rows are scored one by
one, repeated ones too; with no training text every token is unknown, with probability 1; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwave.llm import blocks as B
from postwave.llm.common import discard, release, stored

K = 5
#: Text of a block: the larger, the fewer n-grams are sent more than once.
BLOCK_BYTES = 6 << 20
BEGIN, UNKNOWN = np.uint64(1 << 62), np.uint64(1 << 63)
ODD = np.uint64(0x9E3779B97F4A7C15)


def pack_values(x: np.ndarray) -> bytes:
    """Values that repeat: the distinct ones and each one's number, byte planes apart."""
    values, at = np.unique(x, return_inverse=True)
    planes = at.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return len(values).to_bytes(8, "little") + values.astype("<f8").tobytes() + B.pack(planes)


def unpack_values(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    values = np.frombuffer(raw, "<f8", n, 8)
    planes = B.unpack(raw[8 + 8 * n:], np.uint8).reshape(4, -1)
    return values[np.ascontiguousarray(planes.T).view("<u4").ravel()]


def lower_packed(values: np.ndarray) -> bytes:
    """Probabilities of the level below: for single words, which it follows from, the word's count."""
    return pack_planes(values) if values.dtype == np.int64 else pack_values(values)


def lower_values(raw: bytes, c: dict | None) -> np.ndarray:
    """What ``lower_packed`` packed; ``c`` (level 1) turns counts into probabilities."""
    return unpack_values(raw) if c is None else of_words(unpack_planes(raw).astype(np.int64), c)


def of_words(count: np.ndarray, c: dict) -> np.ndarray:
    """Level 1: probability of a word by its count."""
    return np.where(count > 0, of_count(c["d"], count) / max(c["total"], 1) * c["scale"], c["unknown"])


def pack_planes(x: np.ndarray) -> bytes:
    return B.pack(np.ascontiguousarray(x).astype("<u8").view(np.uint8).reshape(-1, 8).T)


def unpack_planes(raw: bytes) -> np.ndarray:
    planes = B.unpack(raw, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """d[c] for counts 0..K; d[K + 1] = 1 stands for all above."""
    n = [0, *counts_of_counts]
    d = np.ones(K + 2)
    if all(n[1:K + 2]):
        a = (K + 1) * n[K + 1] / n[1]
        d[1:K + 1] = [((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) if a < 1 else -1 for r in range(1, K + 1)]
    if not all(n[1:K + 2]) or not ((d[1:K + 1] > 0) & (d[1:K + 1] < 1)).all():
        delta = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.0
        delta = min(max(delta, 0.01), 0.99)
        d[1:K + 1] = [(r - delta) / r for r in range(1, K + 1)]
    return d


def of_count(d: np.ndarray, c: np.ndarray) -> np.ndarray:
    return d[np.minimum(c, K + 1)] * c


class Replay:
    """The tokens of a block and what is known of them, level by level."""

    def __init__(self, raw: list[bytes], held: list[bool]):
        words = [t.lower().split() + [b""] for t in raw]     # bytes.lower(): A-Z alone; b"" is the end token
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        coded = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.n_words = len(coded.dictionary)
        self.doc = np.repeat(np.arange(len(words)), self.sizes)
        self.train = ~np.array(held, bool)[self.doc]
        keys = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, self.n_words)
        self.keys, self.key_of = np.unique(keys, return_inverse=True)
        self.first = np.zeros(len(self.codes), bool)
        self.first[np.cumsum(self.sizes) - self.sizes] = True

    def word_counts(self) -> np.ndarray:
        """Training occurrences of each key."""
        per_word = np.bincount(self.codes[self.train], minlength=self.n_words)
        return np.bincount(self.key_of, weights=per_word, minlength=len(self.keys)).astype(np.int64)

    def words(self, ids: np.ndarray, counts: np.ndarray, c: dict) -> None:
        """Level 1: numbers and counts of the keys."""
        self.wid, self.wc = ids[self.key_of], counts[self.key_of]
        self.p = of_words(self.wc, c)[self.codes]
        before = np.append(0, self.codes[:-1] + 1)
        self.history = np.where(self.first, 0, before)
        self.hid = np.append(BEGIN, self.wid)
        self.hc = np.append(c["documents"], self.wc)

    def requests(self, most: int, bits: int, level: int) -> None:
        """The distinct n-grams of the next level whose history was seen, in the order in which they are sent."""
        self.at = np.flatnonzero(self.hc[self.history] > 0)
        pair = self.history[self.at] * self.n_words + self.codes[self.at]
        uniq, one, self.inverse = np.unique(pair, return_index=True, return_inverse=True)
        h, w = uniq // self.n_words, uniq % self.n_words
        hid, self.hcount = self.hid[h], self.hc[h]
        wid = np.where(self.wc[w] > 0, self.wid[w], UNKNOWN)
        self.lower = self.p[self.at][one]
        n = np.bincount(self.inverse, weights=self.train[self.at], minlength=len(uniq)).astype(np.int64)
        parts = np.uint64(1) + self.hcount.astype(np.uint64) // np.uint64(most)
        bucket = B.mix(hid + (B.mix(wid) % parts) * ODD) >> np.uint64(64 - bits)
        self.order = np.lexsort((wid, hid, bucket))
        o = self.order
        self.sent = {"h": hid[o], "w": wid[o], "n": n[o], "lower": (self.wc[w] if level == 2 else self.lower)[o], "split": (parts > 1)[o]}
        self.edges = np.searchsorted(bucket[o], np.arange((1 << bits) + 1, dtype=np.uint64))

    def answered(self, d: np.ndarray, counts: np.ndarray, alpha: np.ndarray, scaled: np.ndarray, ids: np.ndarray | None, documents: int) -> None:
        """Probabilities of this level, from answers in the order of the requests; then the next level's histories."""
        count, scale = np.empty(len(counts), np.int64), np.empty(len(counts), bool)
        back = np.zeros(len(counts))
        count[self.order], scale[self.order] = counts, scaled
        back[self.order] = alpha
        seen = of_count(d, count) / self.hcount
        seen = np.where(scale, seen * (self.hcount / (self.hcount + 1.0)), seen)
        self.p[self.at] = np.where(count > 0, seen, back * self.lower)[self.inverse]
        if ids is not None:
            number = np.empty(len(counts), np.uint64)
            number[self.order] = ids
            none = len(count) + 1
            gram = np.full(len(self.codes), none, np.int64)
            gram[self.at] = self.inverse + 1
            self.history = np.where(self.first, 0, np.append(none, gram[:-1]))
            self.hid = np.concatenate([[BEGIN], number, [np.uint64(0)]])
            self.hc = np.concatenate([[documents], count, [0]])


def _blocks_of(batch: pa.RecordBatch, levels: int) -> Iterator[tuple]:
    """block, texts, held flags, answers per level (dict by bucket), row number, of each row."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        row = {n: batch.column(k)[i].as_py() for k, n in enumerate(names) if n != "ids"}
        answers = [{x["bucket"]: x for x in row[f"a{n}"] or ()} for n in range(1, levels + 1)]
        yield row["block"], B.texts(row["sizes"], row["data"]), row["held"], answers, i


def replay(raw: list[bytes], held: list[bool], answers: list[dict], consts: list[dict], most: int, bits: int) -> Replay:
    """A block with all levels that ``answers`` hold."""
    r = Replay(raw, held)
    for n, answer in enumerate(answers, 1):
        got = [answer[b] for b in sorted(answer)]
        if n == 1:
            r.words(np.concatenate([B.unpack_sorted(x["ids"]) for x in got]), np.concatenate([B.unpack(x["counts"], "<i8") for x in got]), consts[0])
            continue
        r.requests(most, bits, n)
        counts = np.concatenate([B.unpack(x["counts"], "<i8") for x in got]) if got else np.zeros(0, np.int64)
        scaled = np.concatenate([B.unpack(x["scaled"], bool) for x in got]) if got else np.zeros(0, bool)
        alpha = np.zeros(len(counts))
        if got:
            alpha[counts == 0] = np.concatenate([unpack_values(x["alpha"]) for x in got])
        ids = np.concatenate([unpack_planes(x["ids"]) for x in got]) if got and got[0]["ids"] else None
        if ids is None and n < len(consts):
            ids = np.zeros(0, np.uint64)
        r.answered(consts[n - 1]["d"], counts, alpha, scaled, ids, consts[0]["documents"])
    return r


SENT = "bucket int, block long, h binary, w binary, n binary, lower binary, split binary"
ANSWER = "block long, bucket int, ids binary, counts binary, scaled binary, alpha binary"


def _send_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw, held, _, _ in _blocks_of(batch, 0):
                r = Replay(raw, held)
                n, at = r.word_counts(), B.cuts(r.keys, bits)
                full = [b for b in range(1 << bits) if at[b] < at[b + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int64()),
                     pa.array([B.pack_sorted(r.keys[at[b]:at[b + 1]]) for b in full], pa.binary()), pa.array([None] * len(full), pa.binary()),
                     pa.array([B.pack(n[at[b]:at[b + 1]].astype("<i8")) for b in full], pa.binary()),
                     pa.array([None] * len(full), pa.binary()), pa.array([None] * len(full), pa.binary())], [x.split()[0] for x in SENT.split(", ")])
    return run


def _send_grams(level: int, consts: list[dict], most: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw, held, answers, _ in _blocks_of(batch, level - 1):
                r = replay(raw, held, answers, consts, most, bits)
                r.requests(most, bits, level)
                s, at = r.sent, r.edges
                full = [b for b in range(1 << bits) if at[b] < at[b + 1]]
                cut = lambda k, b: s[k][at[b]:at[b + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int64()),
                     pa.array([B.pack_sorted(cut("h", b)) for b in full], pa.binary()), pa.array([pack_planes(cut("w", b)) for b in full], pa.binary()),
                     pa.array([B.pack(cut("n", b).astype("<i8")) for b in full], pa.binary()), pa.array([lower_packed(cut("lower", b)) for b in full], pa.binary()),
                     pa.array([B.pack(np.unique(cut("h", b)[cut("split", b)])) for b in full], pa.binary())], [x.split()[0] for x in SENT.split(", ")])
    return run


TABLE = ("bucket int, h binary, w binary, n binary, lower binary, split binary, blocks array<long>, places array<binary>, "
         "total long, distinct long, counts_of_counts array<long>")


def _merge(words: bool, single: dict | None = None):
    def run(group: pa.Table) -> pa.Table:
        cols = {c: group.column(c).to_pylist() for c in ("block", "h", "w", "n", "lower", "split")}
        hs = [B.unpack_sorted(x) for x in cols["h"]]
        sizes = [len(x) for x in hs]
        h = np.concatenate(hs)
        n = np.concatenate([B.unpack(x, "<i8") for x in cols["n"]])
        del hs
        if words:
            order = np.argsort(h, kind="stable")
            new = np.append(True, h[order][1:] != h[order][:-1])
        else:
            w = np.concatenate([unpack_planes(x) for x in cols["w"]])
            order = np.lexsort((w, h))
            new = np.append(True, (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1]))
        at = np.flatnonzero(new)
        count = np.add.reduceat(n[order], at)
        place = np.empty(len(h), np.int64)
        place[order] = np.cumsum(new) - 1
        parts = np.split(place.astype("<u4"), np.cumsum(sizes)[:-1])
        out = {"bucket": group.column("bucket")[0].as_py(), "h": B.pack_sorted(h[order][at]), "w": None, "n": B.pack(count.astype("<i8")), "lower": None, "split": None,
               "blocks": cols["block"], "places": [B.pack(p.view(np.uint8).reshape(-1, 4).T) for p in parts],
               "total": int(count.sum()), "distinct": int((count > 0).sum()), "counts_of_counts": [int((count == r).sum()) for r in range(1, K + 2)]}
        if not words:
            out["w"] = pack_planes(w[order][at])
            out["lower"] = pack_values(np.concatenate([lower_values(x, single) for x in cols["lower"]])[order][at])
            out["split"] = B.pack(np.unique(np.concatenate([B.unpack(x, "<u8") for x in cols["split"]])))
        kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
        return pa.table({f.split()[0]: pa.array([out[f.split()[0]]], kinds[f.split()[1]]) for f in TABLE.split(", ")})
    return run


def _sums(row: dict, d: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct histories of a bucket, where each begins, and its count, discounted count and lower mass of seen words."""
    h, n, lower = B.unpack_sorted(row["h"]), B.unpack(row["n"], "<i8"), unpack_values(row["lower"])
    at = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    return h, n, h[at], at, np.add.reduceat(n, at), np.add.reduceat(of_count(d, n), at), np.add.reduceat(np.where(n > 0, lower, 0.0), at)


def _split_sums(d: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                split = B.unpack(row["split"], "<u8")
                if not len(split):
                    continue
                _, _, h, _, c, dc, low = _sums(row, d)
                k = np.flatnonzero(np.isin(h, split))
                yield pa.RecordBatch.from_arrays([pa.array([row["bucket"]] * len(k), pa.int32()), pa.array(h[k].view(np.int64)), pa.array(c[k]), pa.array(dc[k]), pa.array(low[k])],
                                                 ["bucket", "h", "c", "dc", "low"])
    return run


def _answer_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            n, base = B.unpack(row["n"], "<i8"), np.uint64(row["bucket"] << 32)
            for block, place in zip(row["blocks"], row["places"]):
                p = np.ascontiguousarray(B.unpack(place, np.uint8).reshape(4, -1).T).view("<u4").ravel()
                yield _one(block, row["bucket"], B.pack_sorted(base + p.astype(np.uint64)), B.pack(n[p].astype("<i8")), None, None)


def _one(*values) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [x.split()[0] for x in ANSWER.split(", ")])


def _answer_grams(d: np.ndarray, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                h, n, own, at, c, dc, low = _sums(row, d)
                for x in row["sums"] or ():
                    k = int(np.searchsorted(own, np.uint64(x["h"] & (2**64 - 1))))
                    c[k], dc[k], low[k] = x["c"], x["dc"], x["low"]
                seen = np.where(c > 0, dc / np.maximum(c, 1), 0.0)
                full = (c > 0) & (seen >= 1 - 1e-12)
                seen = np.where(full, seen * (c / (c + 1.0)), seen)
                alpha = np.where(c > 0, (1.0 - seen) / np.maximum(1.0 - low, 1e-300), 1.0)
                size = np.diff(np.append(at, len(h)))
                alpha, full = np.repeat(alpha, size), np.repeat(full, size)
                base = np.uint64(row["bucket"] << 32)
                for block, place in zip(row["blocks"], row["places"]):
                    p = np.ascontiguousarray(B.unpack(place, np.uint8).reshape(4, -1).T).view("<u4").ravel()
                    yield _one(block, row["bucket"], None if last else pack_planes(base + p.astype(np.uint64)), B.pack(n[p].astype("<i8")),
                               B.pack(full[p]), pack_values(alpha[p][n[p] == 0]))
    return run


def _per_block(answers: DataFrame, level: int) -> DataFrame:
    return (answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "ids", "counts", "scaled", "alpha")).alias(f"a{level}"))
            .withColumnRenamed("block", f"b{level}"))


def _with_answers(blocks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    for n, a in enumerate(answers, 1):
        blocks = blocks.join(_per_block(a, n), F.col("block") == F.col(f"b{n}"), "left").drop(f"b{n}")
    return blocks


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Learns from documents whose crc32(id as text) mod ``folds`` isn't 0; n-grams up to ``order`` words."""
    held = F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % folds == 0, F.lit(False))
    blocks = B.build(docs, id_col, text_col, "katz-blocks", {"held": held}, BLOCK_BYTES).drop("digests")
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    documents = blocks.select(F.sum(F.size(F.filter("held", lambda x: ~x))).alias("n"), F.count(F.lit(1)).alias("blocks")).first()
    bits = B.bucket_bits(documents["blocks"] * 2)
    consts: list[dict] = []
    answers: list[DataFrame] = []
    most = 1
    for level in range(1, order + 1):
        src = _with_answers(blocks.drop("ids"), answers)
        sent = src.mapInArrow(_send_words(bits) if level == 1 else _send_grams(level, consts, most, bits), SENT)
        merge = _merge(level == 1, consts[0] if level == 2 else None)
        table = stored(sent.groupBy("bucket").applyInArrow(merge, TABLE), f"katz-ngrams/level={level}")
        release(docs.sparkSession)
        got = table.agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct"),
                        *[F.sum(F.col("counts_of_counts")[r]).alias(f"n{r}") for r in range(K + 1)]).first()
        d = discounts([got[f"n{r}"] or 0 for r in range(K + 1)])
        if level == 1:
            total = got["total"] or 0
            most = max(1, total >> (bits + 2))
            dc = table.select(F.col("n")).mapInArrow(_discounted(d), "dc double").agg(F.sum("dc")).first()[0] or 0.0
            unknown = max(1.0 - dc / total, 1.0 / (total + 1)) if total else 1.0
            consts.append({"d": d, "total": total, "distinct": got["distinct"] or 0, "documents": documents["n"] or 0,
                           "unknown": unknown, "scale": (1.0 - unknown) / (dc / total) if total else 1.0})
            answers.append(stored(table.select("bucket", "n", "blocks", "places").mapInArrow(_answer_words, ANSWER), "katz-answers-1"))
            discard(table)
            continue
        consts.append({"d": d})
        parts = table.select("bucket", "h", "n", "lower", "split").mapInArrow(_split_sums(d), "bucket int, h long, c long, dc double, low double")
        parts = stored(parts, f"katz-split-{level}")
        sums = parts.groupBy("h").agg(F.sum("c").alias("c"), F.sum("dc").alias("dc"), F.sum("low").alias("low")).withColumnRenamed("h", "sh")
        sums = (parts.select("bucket", "h").join(sums, F.col("h") == F.col("sh")).groupBy("bucket").agg(F.collect_list(F.struct("h", "c", "dc", "low")).alias("sums"))
                .withColumnRenamed("bucket", "sb"))
        sums = stored(sums, f"katz-sums-{level}")
        src = table.select("bucket", "h", "n", "lower", "blocks", "places").join(sums, F.col("bucket") == F.col("sb"), "left").drop("sb")
        answers.append(stored(src.mapInArrow(_answer_grams(d, level == order), ANSWER), f"katz-answers-{level}"))
        discard(table, parts, sums)
        del src, sent
        release(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = consts[0]
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            for _, raw, flags, got, i in _blocks_of(batch, order):
                r = replay(raw, flags, got, consts, most, bits)
                n = len(raw)
                count = r.wc[r.codes]
                base = np.log10((count + 0.1) / (c["total"] + 0.1 * (c["distinct"] + 1)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, 1).flatten(), pa.array(flags, pa.bool_()), pa.array(r.sizes), pa.array(np.bincount(r.doc, weights=count > 0, minlength=n).astype(np.int64)),
                     pa.array(np.full(n, c["total"], np.int64)), pa.array(np.bincount(r.doc, weights=base, minlength=n)),
                     pa.array(np.bincount(r.doc, weights=np.log10(r.p), minlength=n))], names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return _with_answers(blocks, answers).mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _discounted(d: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([float(of_count(d, B.unpack(x, "<i8")).sum()) for x in batch.column(0).to_pylist()], pa.float64())], ["dc"])
    return run
