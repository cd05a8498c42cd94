"""Importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Target texts are labelled documents of good quality that aren't toxic (at most ``fit_documents``, those of
the least hash of the id); raw text is every document. Unigrams and bigrams of lower-case words are
counted in ``2 ** bits`` buckets each. A document's log weight is the sum over its n-grams of
``ln((target + m) / (raw * share + m))``, ``share`` being target over raw tokens and ``m`` a pseudo-count
per order; its own n-grams are left out of both counts, so that neither labels nor rare words of its own favour it.
A Gumbel variable that depends on id and seed is added, and the ``pick_share`` of all documents with
the greatest sums is kept: a sample without replacement in proportion to the weights.

Scale: counts are fixed-size arrays, summed per task, then per range of buckets; the model is a
fixed ``4 * 2 ** bits`` numbers. The threshold of the top k comes from counts over ranges of the key, narrowed four
times, so no task sees all keys.

Defined cases: null and empty texts have weight 0; a null id is noise of its own; rows of equal id and text have equal keys and are kept or left
together (so a tie at the threshold may keep more than k); labels that are null or differ for one
document count by the worse one; with no target labels all weights are 0; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwave.llm import blocks as B
from postwave.llm.common import encoded, ready, slices, stored

BITS, RANGES = 20, 32
#: Rows that one sum of the tree adds up.
FAN = 64
PSEUDO = (3.0, 20.0)


def buckets(texts: list[bytes], bits: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For unigrams and bigrams: text number, bucket and count, by text, then bucket."""
    split = [t.decode("utf-8", "surrogatepass").lower().split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    if not sizes.sum():
        z = np.zeros(0, np.int64)
        return [(z, z, z)] * 2
    coded = pa.array([w.encode("utf-8", "surrogatepass") for ws in split for w in ws], pa.binary()).dictionary_encode()
    names = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    h = names[coded.indices.to_numpy()]
    doc = np.repeat(np.arange(len(split)), sizes)
    same = doc[1:] == doc[:-1]
    out = []
    for d, x in ((doc, h), (doc[1:][same], (h[:-1] * np.uint64(31) + h[1:])[same])):
        key, n = np.unique((d << bits) | (B.mix(x) >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
        out.append((key >> bits, key & ((1 << bits) - 1), n))
    return out


def target_ids(labels: DataFrame, id_col: str, fit_documents: int) -> DataFrame:
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0))
    judged = (labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("target_id"))
              .agg(F.min(F.coalesce(good, F.lit(False))).alias("good")).where("good"))
    return judged.select("target_id").orderBy(F.xxhash64("target_id"), "target_id").limit(fit_documents)


def model(src: DataFrame, bits: int) -> np.ndarray:
    """Counts [target, raw] x [unigrams, bigrams] x buckets."""
    width = (1 << bits) // RANGES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sender = TaskContext.get().partitionId()
        total = np.zeros((2, 2, 1 << bits), np.int64)
        for part in slices(batches, "__text"):
            is_target = np.array(part.column(1).to_pylist(), bool)
            for k, (doc, bucket, n) in enumerate(buckets(encoded(part, "__text"), bits)):
                total[1, k] += np.bincount(bucket, weights=n, minlength=1 << bits).astype(np.int64)
                t = is_target[doc]
                total[0, k] += np.bincount(bucket[t], weights=n[t], minlength=1 << bits).astype(np.int64)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(RANGES), pa.int32()), pa.array([sender] * RANGES, pa.int64()), pa.array([B.pack(total[:, :, r * width:(r + 1) * width].astype("<i8")) for r in range(RANGES)], pa.binary())],
                                             ["range", "sender", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(B.unpack(x, "<i8") for x in group.column("counts").to_pylist())
        return pa.table({"range": group.column("range").slice(0, 1), "sender": group.column("sender").slice(0, 1), "counts": pa.array([B.pack(total)], pa.binary())})

    schema = "range int, sender long, counts binary"
    sums, tasks = src.mapInArrow(count, schema), src.rdd.getNumPartitions()
    while True:
        # A tree of sums: a group has the rows of FAN tasks at most.
        sums = sums.withColumn("sender", F.floor(F.col("sender") / FAN).cast("long")).groupBy("range", "sender").applyInArrow(add, schema)
        if tasks <= FAN:
            break
        tasks = -(-tasks // FAN)
    rows = sums.collect()                                                                           # RANGES rows of fixed size
    out = np.zeros((2, 2, 1 << bits), np.int64)
    for r in rows:
        out[:, :, r["range"] * width:(r["range"] + 1) * width] = B.unpack(r["counts"], "<i8").reshape(2, 2, width)
    return out


def weights(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
            fit_documents: int = 50_000, bits: int = BITS, seed: int = 0) -> DataFrame:
    """doc_id, log_weight and key (with the Gumbel noise) of every document."""
    spark = ready(docs.sparkSession)
    ids = F.broadcast(target_ids(labels, label_id, fit_documents))      # fit_documents ids at most
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    src = src.join(ids, F.col("doc_id") == F.col("target_id"), "left").select("doc_id", F.col("target_id").isNotNull().alias("is_target"), "__text")
    counts = model(src, bits)
    shared = spark.sparkContext.broadcast(counts.astype(np.float32 if counts.max(initial=0) < 1 << 24 else np.float64))
    # Tokens of unigrams: how much raw text stands for one part of target text.
    share = float(counts[0, 0].sum()) / max(1.0, float(counts[1, 0].sum()))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for part in slices(batches, "__text"):
            texts = encoded(part, "__text")
            is_target = np.array(part.column(1).to_pylist(), bool)
            total = np.zeros(len(texts))
            for k, (doc, bucket, n) in enumerate(buckets(texts, bits) if share else ()):
                target = table[0, k][bucket] - np.where(is_target[doc], n, 0)
                raw = table[1, k][bucket] - n
                ratio = np.log((target + PSEUDO[k]) / (raw * share + PSEUDO[k]))
                total += np.bincount(doc, weights=n * ratio, minlength=len(texts))
            u = np.array([(xxhash.xxh3_64_intdigest(str(i), seed) + 0.5) / 2.0**64 for i in part.column(0).to_pylist()])
            u = np.clip(u, 1e-300, 1 - 1e-16)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total), pa.array(total - np.log(-np.log(u)))], ["doc_id", "log_weight", "key"])

    return src.mapInArrow(run, f"doc_id {kind}, log_weight double, key double")


def threshold(keys: DataFrame, k: int) -> float | None:
    """The k-th greatest key: the range that holds it is divided by counts until it is one value."""
    if k <= 0:
        return None
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return None
    parts = 4096
    while low < high:
        # How many keys lie in each part of low..high; keys above high are among the k already.
        step = (high - low) / parts
        if step <= 0 or low + step == low:
            got = [r[0] for r in keys.where(F.col("key").between(low, high)).select("key").distinct().orderBy(F.desc("key")).limit(parts).collect()]
            above = keys.where(F.col("key") > F.lit(high)).count()
            counts = {r[0]: r[1] for r in keys.where(F.col("key").between(low, high)).groupBy("key").count().where(F.col("key").isin(got)).collect()}
            for v in got:
                above += counts[v]
                if above >= k:
                    return v
            return low
        part = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit(step)), F.lit(parts - 1))
        part = F.when(F.col("key") > F.lit(high), F.lit(parts)).otherwise(part)
        rows = (keys.where(F.col("key") >= F.lit(low)).groupBy(part.alias("part"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect())        # parts + 1 rows at most
        above = 0
        for r in sorted(rows, key=lambda r: -r["part"]):
            above += r["n"]
            if above >= k:
                low, high = r["low"], r["high"]
                break
    return low


def resample(docs: DataFrame, labels: DataFrame, pick_share: float = 0.8, **options) -> DataFrame:
    """doc_id, log_weight, key, kept of every document."""
    keys = stored(weights(docs, labels, **options), "importance-keys")
    at = threshold(keys, round(keys.count() * pick_share))
    return keys.withColumn("kept", F.lit(False) if at is None else F.col("key") >= F.lit(at))
