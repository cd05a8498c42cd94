"""Near-duplicates: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

Shingles are five lower-case words (a shorter text is one shingle). A shingle's weight in a text is its
count times ``1 + ln(N / df) / (2 ln N)``, df counted over all N distinct texts; the factor runs from 1.5
down to 1, so that copies of a text, which raise df, don't make their few edits outweigh what they share.
Two texts are linked if their weighted Jaccard similarity is ``similarity`` or more.

1. Documents are packed into blocks; equal texts become one class with one representative.
2. Document frequencies of all shingles are counted in buckets, from sorted arrays; each block gets back
   those of its shingles that two texts or more hold.
3. A text whose shared shingles hold less than ``similarity`` of its weight can't have a partner, and goes
   no further; this loses no pair. The others get consistent weighted samples, ``bands`` of ``rows``.
4. Texts of one band value are compared with two of them on the full weighted vectors, in three rounds: those not
   yet in the component of the first ones with others. Where a band value still holds several components (such as
   texts of a common passage that are otherwise unlike), its texts are grouped anew by two neighbouring band values, which
   unlike texts share far less often, and compared likewise until a round links nothing more.
5. What these rounds leave is settled exactly: all texts of band values that still hold several components are joined by
   their prefixes, the rarest shingles that any partner must share one of, and every pair of different components that
   the bounds don't rule out is compared. So no candidate link between different texts is lost.
6. Connected components of the links, then of their copies, give each document the class of the least id.

Defined cases: null and empty texts count as equal and are one class; texts without a word are one
class each per distinct text; rows that repeat an id and text are one document; null ids are
kept and are the least; ties go to the least id; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwave.llm import blocks as B
from postwave.llm.common import bucketed, discard, forget, release, stored
from postwave.llm.components import components

WORDS, SIMILARITY, BANDS, ROWS = 5, 0.8, 16, 3
#: Texts of a group's largest component that its other texts are compared with in a round.
LEADERS = 2
#: Rounds within groups of one band value, before those of two.
COARSE_ROUNDS = 3
#: Shingles times samples that are drawn at once.
SAMPLE_CELLS = 1 << 18
#: Fixed odd multipliers of the words of a shingle.
MULTIPLY = np.random.default_rng(77).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(raw: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle and count, sorted by text, then shingle."""
    split = [t.decode("utf-8", "surrogatepass").lower().split() for t in raw]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    total = int(counts.sum())
    if not total:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z
    coded = pa.array([w.encode("utf-8", "surrogatepass") for ws in split for w in ws], pa.binary()).dictionary_encode()
    names = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    own = names[coded.indices.to_numpy()]
    doc = np.repeat(np.arange(len(split)), counts)
    first = np.cumsum(counts) - counts
    n = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    sdoc = np.repeat(np.arange(len(split)), n)
    begin = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    length = np.minimum(counts, words)[sdoc]
    h = length.astype(np.uint64)
    for k in range(words):
        use = length > k
        h = h + np.where(use, own[np.minimum(begin + k, total - 1)] * MULTIPLY[k], np.uint64(0))
    h = B.mix(h)
    order = np.lexsort((h, sdoc))
    sdoc, h = sdoc[order], h[order]
    new = np.append(True, (sdoc[1:] != sdoc[:-1]) | (h[1:] != h[:-1]))
    at = np.flatnonzero(new)
    return sdoc[at], h[at], np.diff(np.append(at, len(h)))


def signatures(keys: np.ndarray, weights: np.ndarray, bands: int, rows: int) -> list[int]:
    """The band values of a text's shingles by improved consistent weighted sampling."""
    log_w = np.log(weights)
    seeds = B.mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    step = max(1, SAMPLE_CELLS // max(1, len(keys)))
    drawn = []
    for k in range(0, len(seeds), step):                # a long text's samples in parts, to bound the memory
        z1 = B.mix(keys[None, :] ^ seeds[k:k + step, None])
        z2 = B.mix(z1 + np.uint64(0x632BE59BD9B4E019))
        beta = (B.mix(z2 + np.uint64(0x632BE59BD9B4E019)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        u = [((z >> np.uint64(s)) & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 + 2.0**-33 for z in (z1, z2) for s in (0, 32)]
        r, c = -np.log(u[0] * u[1]), -np.log(u[2] * u[3])
        t = np.floor(log_w / r + beta)
        best = np.argmin(np.log(c) - r * (t - beta) - r, axis=1)
        drawn.append(keys[best] ^ B.mix(t[np.arange(len(best)), best].astype(np.int64).view(np.uint64)))
    samples = np.concatenate(drawn).reshape(bands, rows)
    value = np.arange(1, bands + 1, dtype=np.uint64)
    for row in range(rows):
        value = B.mix(value * np.uint64(3) ^ samples[:, row])
    return value.view(np.int64).tolist()


def weigh(df: np.ndarray, tf: np.ndarray, n: int) -> np.ndarray:
    return tf * (1.0 + np.log(n / df) / (2.0 * math.log(n)) if n > 1 else np.ones(len(df)))


def _representatives(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (id, digest, root digest's least id) and, per block, the places of texts to leave out."""
    rows = blocks.select("block", F.posexplode(F.arrays_zip("ids", "digests")).alias("at", "x")).select(
        "block", "at", F.col("x.ids").alias("id"), F.col("x.digests").alias("digest"))
    best = rows.groupBy("digest").agg(F.min(F.struct("id", "block", "at")).alias("best")).select(F.col("digest").alias("d"), "best")
    out = (rows.join(best, F.col("digest") == F.col("d")).where((F.col("block") != F.col("best.block")) | (F.col("at") != F.col("best.at")))
           .groupBy("block").agg(F.collect_list("at").alias("out")))
    return rows.select("id", "digest"), stored(out.withColumnRenamed("block", "out_block"), "neardup-copies")


def frequencies(blocks: DataFrame, words: int, bits: int) -> DataFrame:
    """block, keys, df: for each block those of its shingles that two texts or more hold."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, sizes, data, out in zip(*(batch.column(k).to_pylist() for k in range(4))):
                raw = B.texts(sizes, data)
                for k in out or ():
                    raw[k] = b""
                _, h, _ = shingles(raw, words)
                keys, n = np.unique(h, return_counts=True)
                at = B.cuts(keys, bits)
                full = [b for b in range(1 << bits) if at[b] < at[b + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([number] * len(full), pa.int64()),
                     pa.array([B.pack_sorted(keys[at[b]:at[b + 1]]) for b in full], pa.binary()),
                     pa.array([B.pack(n[at[b]:at[b + 1]].astype("<i4")) for b in full], pa.binary())], ["bucket", "block", "keys", "n"])

    def count(group: pa.Table) -> pa.Table:
        parts = [(b, B.unpack_sorted(k), B.unpack(n, "<i4")) for b, k, n in zip(*(group.column(c).to_pylist() for c in ("block", "keys", "n")))]
        keys = np.concatenate([p[1] for p in parts])
        order = np.argsort(keys, kind="stable")
        runs = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
        total = np.add.reduceat(np.concatenate([p[2] for p in parts])[order].astype(np.int64), runs)
        df = np.empty(len(keys), np.int64)
        df[order] = np.repeat(total, np.diff(np.append(runs, len(keys))))
        del order, keys
        rows, at = [], 0
        for b, k, _ in parts:
            own = df[at:at + len(k)]
            at += len(k)
            if (two := own >= 2).any():
                rows.append((b, B.pack_sorted(k[two]), B.pack(own[two].astype("<i8"))))
        return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "keys": pa.array([r[1] for r in rows], pa.binary()),
                         "df": pa.array([r[2] for r in rows], pa.binary())})

    sent = blocks.select("block", "sizes", "data", "out").mapInArrow(send, "bucket int, block long, keys binary, n binary")
    return sent.groupBy("bucket").applyInArrow(count, "block long, keys binary, df binary")


def candidates(blocks: DataFrame, shared: DataFrame, n_texts: int, words: int, similarity: float, bands: int, rows: int) -> DataFrame:
    """id, digest, keys, weights, counts, bands of each text that can have a partner."""
    answers = shared.groupBy("block").agg(F.collect_list(F.struct("keys", "df")).alias("answers")).withColumnRenamed("block", "ab")
    src = blocks.join(answers, F.col("block") == F.col("ab")).select("ids", "digests", "sizes", "data", "out", "answers")
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = B.texts(batch.column(2)[i].as_py(), batch.column(3)[i].as_py())
                for k in batch.column(4)[i].as_py() or ():
                    raw[k] = b""
                got = [(B.unpack_sorted(x["keys"]), B.unpack(x["df"], "<i8")) for x in batch.column(5)[i].as_py()]
                known = np.concatenate([k for k, _ in got])
                order = np.argsort(known)
                known, df_known = known[order], np.concatenate([d for _, d in got])[order]
                doc, h, tf = shingles(raw, words)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                df = np.where(known[at] == h, df_known[at], 1)
                w = weigh(df, tf, n_texts)
                total = np.bincount(doc, weights=w, minlength=len(raw))
                common = np.bincount(doc, weights=np.where(df > 1, w, 0.0), minlength=len(raw))
                chosen = np.flatnonzero((total > 0) & (common >= (similarity - 1e-9) * total))
                begin, end = np.searchsorted(doc, chosen), np.searchsorted(doc, chosen, "right")
                values, keys, weights, counts = [], [], [], []
                for a, b in zip(begin.tolist(), end.tolist()):
                    values.append(signatures(h[a:b], w[a:b], bands, rows))
                    keys.append(h[a:b].tobytes())
                    weights.append(w[a:b].tobytes())
                    counts.append(tf[a:b].astype("<i4").tobytes())
                take = pa.array(chosen)
                ids = batch.column(0).slice(i, 1).flatten().take(take)
                digests = batch.column(1).slice(i, 1).flatten().take(take)
                yield pa.RecordBatch.from_arrays([ids, digests, pa.array(keys, pa.binary()), pa.array(weights, pa.binary()),
                                                  pa.array(counts, pa.binary()), pa.array(values, pa.list_(pa.int64()))],
                                                 ["id", "digest", "keys", "weights", "counts", "bands"])

    return src.mapInArrow(run, f"id {kind}, digest binary, keys binary, weights binary, counts binary, bands array<long>")


def weighted_jaccard(k1: np.ndarray, w1: np.ndarray, k2: np.ndarray, w2: np.ndarray) -> float:
    _, a, b = np.intersect1d(k1, k2, assume_unique=True, return_indices=True)
    common = float(np.minimum(w1[a], w2[b]).sum())
    return common / max(float(w1.sum()) + float(w2.sum()) - common, 1e-300)


def verify(pairs: DataFrame, vectors: DataFrame, similarity: float) -> DataFrame:
    """a, b of the pairs whose vectors are similar enough."""
    one = vectors.select(F.col("digest").alias("d1"), F.col("keys").alias("k1"), F.col("weights").alias("w1"))
    two = vectors.select(F.col("digest").alias("d2"), F.col("keys").alias("k2"), F.col("weights").alias("w2"))
    src = pairs.join(two, F.col("b") == F.col("d2")).join(one, F.col("a") == F.col("d1")).select("a", "b", "k1", "w1", "k2", "w2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(2, 6)]
            good = [weighted_jaccard(np.frombuffer(k1, np.uint64), np.frombuffer(w1), np.frombuffer(k2, np.uint64), np.frombuffer(w2)) >= similarity - 1e-9
                    for k1, w1, k2, w2 in zip(*cols)]
            take = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], ["a", "b"])

    return src.mapInArrow(run, "a binary, b binary")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY,
            bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, digest, class_id (least id of the class), kept (the document is its class's) of every document."""
    packed = B.build(docs, id_col, text_col, "neardup-blocks")
    members, copies = _representatives(packed)
    members = stored(members.distinct(), "neardup-members")
    n_texts = members.select("digest").distinct().count()
    bits = B.bucket_bits(packed.count())
    blocks = packed.join(copies, F.col("block") == F.col("out_block"), "left").drop("out_block")
    shared = stored(frequencies(blocks, words, bits), "neardup-frequencies")
    release(docs.sparkSession)
    found = stored(candidates(blocks, shared, n_texts, words, similarity, bands, rows), "neardup-candidates")
    discard(packed, copies, shared)
    release(docs.sparkSession)
    # Every round joins pairs with the vectors: dealt by digest once, these stay where they are.
    vectors = bucketed(found.select("digest", "keys", "weights"), "neardup_vectors", "digest")
    banded = stored(found.select("digest", F.posexplode("bands").alias("band", "value")), "neardup-bands")
    groups = banded.select(F.xxhash64("band", "value").alias("group"), "digest")
    roots, left = linked(groups, vectors, similarity, None, "one", LEADERS, COARSE_ROUNDS)
    # Groups that still hold several components: their texts are grouped anew by two neighbouring band values.
    open_ = left.select("digest").distinct().withColumnRenamed("digest", "od")
    own = banded.join(open_, F.col("digest") == F.col("od"), "left_semi")
    values = own.groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("band", "value"))).alias("values"))
    pair = lambda k: F.xxhash64(k, F.element_at("values", k), F.element_at("values", (k + 1) % bands))
    finer = values.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), pair)).alias("group"), "digest")
    roots, _ = linked(finer, vectors, similarity, roots, "two", 1, None)
    roots = settled(found, left, vectors, roots, n_texts, similarity)
    forget(vectors)
    return _members(members, roots)


def prefix(keys: np.ndarray, weights: np.ndarray, counts: np.ndarray, n: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that a partner must share one of, and the weight that stands before each, in the order of df, then key.

    Those after them weigh less than ``similarity`` of the text, so two texts without a common shingle in both prefixes
    can't be similar. df comes back exactly from weight and count, so that the order is the same in all texts."""
    df = np.rint(n * np.exp(-2.0 * math.log(n) * (weights / counts - 1.0))).astype(np.int64)
    order = np.lexsort((keys, df))
    own = weights[order]
    before = np.cumsum(own) - own
    total = float(own.sum())
    use = (total - before >= (similarity - 1e-6) * total) & (df[order] > 1)
    return keys[order][use], before[use]


def settled(found: DataFrame, groups: DataFrame, vectors: DataFrame, roots: DataFrame, n_texts: int, similarity: float) -> DataFrame:
    """The roots after all texts of groups with several components have been joined exactly."""
    spark = found.sparkSession
    rooted = groups.join(roots, F.col("digest") == F.col("node"), "left").select("group", "digest", F.coalesce("root", "digest").alias("root"))
    several = rooted.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select(F.col("group").alias("g"))
    open_ = stored(rooted.join(several, F.col("group") == F.col("g"), "left_semi").select(F.col("digest").alias("od"), "root").distinct(), "neardup-open")
    if open_.isEmpty():
        return roots
    src = found.join(open_, F.col("digest") == F.col("od")).select("digest", "root", "keys", "weights", "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vs = [(np.frombuffer(k, np.uint64), np.frombuffer(w), np.frombuffer(c, "<i4")) for k, w, c in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            got = [prefix(*v, n_texts, similarity) for v in vs]
            sizes = [len(k) for k, _ in got]
            if not sum(sizes):
                continue
            take = pa.array(np.repeat(np.arange(len(got)), sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.repeat([float(w.sum()) for _, w, _ in vs], sizes)),
                 pa.array(np.concatenate([k for k, _ in got]).view(np.int64)), pa.array(np.concatenate([b for _, b in got]))],
                ["digest", "root", "total", "key", "before"])

    rows = stored(src.mapInArrow(run, "digest binary, root binary, total double, key long, before double"), "neardup-prefixes")
    # A shingle of one component's prefixes only can't link it to another.
    crossing = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select(F.col("key").alias("ck"))
    rows = stored(rows.join(crossing, F.col("key") == F.col("ck"), "left_semi"), "neardup-crossing")
    one = rows.select(F.col("key").alias("k1"), F.col("digest").alias("a"), F.col("root").alias("r1"), F.col("total").alias("t1"), F.col("before").alias("b1"))
    two = rows.select(F.col("key").alias("k2"), F.col("digest").alias("b"), F.col("root").alias("r2"), F.col("total").alias("t2"), F.col("before").alias("b2"))
    # By the first common shingle of similar texts, what follows it in either must make up their common weight.
    enough = F.least(F.col("t1") - F.col("b1"), F.col("t2") - F.col("b2")) >= (F.col("t1") + F.col("t2")) * F.lit((similarity - 1e-6) / (1.0 + similarity))
    pairs = one.join(two, (F.col("k1") == F.col("k2")) & (F.col("r1") < F.col("r2")) & enough).select("a", "b").distinct()
    new = stored(verify(pairs, vectors, similarity), "neardup-settled-links")
    release(spark)
    if new.isEmpty():
        return roots
    return merged_roots(roots, components(rooted_links(new, roots), "neardup-settled"), "settled")


def linked(groups: DataFrame, vectors: DataFrame, similarity: float, roots: DataFrame | None, name: str,
           n_leaders: int, rounds: int | None) -> tuple[DataFrame, DataFrame]:
    """The components that links within groups make, and the groups (group, digest) that held several before the last round.

    In each round every group's largest component names ``n_leaders`` of its texts, others in each round; all texts of
    the group's other components are compared with them. The work of a round is in proportion to the rows, whatever
    the size of a group, and rounds end when one links nothing (a component grows in every other), or after ``rounds``."""
    spark = vectors.sparkSession
    shared = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("group").alias("g"))
    before = groups = stored(groups.join(shared, F.col("group") == F.col("g")).select("group", "digest"), f"neardup-{name}-groups")
    if roots is None:
        roots = spark.createDataFrame([], "node binary, root binary")
    turn = 0
    while True:
        rooted = (groups.join(roots, F.col("digest") == F.col("node"), "left").select("group", "digest", F.coalesce("root", "digest").alias("root")))
        leaders = F.array(*[F.min_by("digest", F.xxhash64("digest", "group", F.lit(turn * n_leaders + k))) for k in range(n_leaders)])
        parts = (rooted.groupBy("group", "root").agg(F.count(F.lit(1)).alias("n"), leaders.alias("leaders"))
                 .groupBy("group").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", F.xxhash64("root", F.lit(turn)), "root", "leaders")).alias("most"))
                 .where("parts > 1").select(F.col("group").alias("g"), F.col("most.root").alias("chosen"), F.col("most.leaders").alias("leaders")))
        groups = stored(rooted.join(parts, F.col("group") == F.col("g")).select("group", "digest", "root", "chosen", "leaders"), f"neardup-{name}-{turn}")
        pairs = groups.where("root <> chosen").select(F.explode(F.array_distinct("leaders")).alias("a"), F.col("digest").alias("b")).distinct()
        new = stored(verify(pairs, vectors, similarity), f"neardup-{name}-links-{turn}")
        release(spark)
        discard(before)
        before, groups, turn = groups, groups.select("group", "digest"), turn + 1
        if new.isEmpty():
            return roots, groups
        # Only the new links' ends move on: from their roots so far to the roots of these.
        roots = merged_roots(roots, components(rooted_links(new, roots), f"neardup-{name}"), name)
        if turn == rounds:
            return roots, groups


def rooted_links(links: DataFrame, roots: DataFrame) -> DataFrame:
    """The links, each end by its root so far."""
    a = roots.withColumnsRenamed({"node": "na", "root": "ra"})
    b = roots.withColumnsRenamed({"node": "nb", "root": "rb"})
    return (links.join(a, F.col("a") == F.col("na"), "left").join(b, F.col("b") == F.col("nb"), "left")
            .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).distinct())


def merged_roots(roots: DataFrame, onward: DataFrame, name: str) -> DataFrame:
    """node, root of all that have been linked: old nodes by way of their root, and the ends of the new links."""
    on = onward.withColumnsRenamed({"node": "n", "root": "r"})
    old = roots.join(on, F.col("root") == F.col("n"), "left").select("node", F.coalesce("r", "root").alias("root"))
    new = onward.join(roots.select(F.col("node").alias("known")), F.col("node") == F.col("known"), "left_anti")
    return stored(old.unionByName(new), f"neardup-{name}-roots")


def _members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Each document with the least id of its class."""
    rooted = stored(members.join(roots, F.col("digest") == F.col("node"), "left").select("id", "digest", F.coalesce("root", "digest").alias("root")), "neardup-rooted")
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("id").isNotNull().alias("has"), "id", "digest")).alias("first")).select(F.col("root").alias("r"), "first")
    return (rooted.join(first, F.col("root") == F.col("r"))
            .select(F.col("id").alias("doc_id"), "digest", F.col("first.id").alias("class_id"),
                    (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("digest") == F.col("first.digest"))).alias("kept")))


def keep_stage(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stand for their class, with all columns (pipeline stage)."""
    kept = (classes(docs, **options).where("kept").select(F.col("doc_id").alias("__d"), F.col("digest").alias("__g")))
    digest = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256))
    return docs.join(stored(kept, "neardup-kept"), F.col("doc_id").eqNullSafe(F.col("__d")) & (digest == F.col("__g")), "left_semi")
