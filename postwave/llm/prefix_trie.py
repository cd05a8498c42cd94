"""The prefix trie of rebuilt conversations, by union-find over the LCP edges of sorted neighbours.

A conversation borrows its first turns from the first one of its score of ids (``conv_id - conv_id % 20``), see ``rebuilt``.
Each turn becomes a digest of role and text, each conversation the sequence of its prefixes' digests (a chain), so equal
entries mean equal prefixes. The sequences are sorted over range partitions. Neighbours that share their first d turns are joined
by an edge of depth d (their longest common prefix). Within each partition the edges are taken in descending depth: joining two components of a
union-find makes a branching node at that depth, and a component's depths above it, down to the next, are nodes with a single child.

A node that reaches over a partition's end stays open. An edge that would join such a node too early (the component's other side
has a deeper open edge) stays too, so of each partition only the spines towards its ends are left: contracted
components with their sums. The contracted forests of 32 neighbouring partitions are merged in the same way, until nothing is open.

What a node's subtree holds needs no second walk: with L(i) the common prefix of i and its left neighbour, the words of distinct nodes in a subtree are those
of its leftmost sequence from the node's depth on and, of every other member, of the turns after L(i); leaves are sequences that the next one doesn't
continue. Both are sums over members, which the components carry.

Sequences are cut at every ``CHUNK`` turns, so that no row grows with its conversation: the trie below each prefix of that many turns is sorted and joined
on its own, after chunk number and prefix, and a conversation's later chunks add to the sums of its earlier ones.
Digests of members are built in two steps: ids in order, packed by range partition, then one pass over each node's packed strings.

Defined cases: null roles and texts are empty; turns come by number, a null one first, equal ones by the digest of role and text (repeated rows are turns of their
own); rows without a conv_id belong to no conversation; an empty table has no nodes, not even a root. Other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postwave.llm.common import ready, stored
from postwave.operators.ranking import global_position

CHUNK = 512
#: Forests merged at a time.
FAN = 32
ROOT = bytes(16)
WIDTH = 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
#: Characters of one packed list of ids.
PACK_CHARS = 1 << 20

ITEM = "part long, seq long, k long, start binary, key binary, words binary, lft long, rgt long, n long, least long, s_all long, s_new long, s_leaf long, own_new long, own_all long"
NODE = "depth long, hash binary, parent binary, conv long, n_convs long, leaves long, saved long"


def rebuilt(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", share: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, dig, words) of every rebuilt turn, depth from 1; and (conv, len) of every conversation.

    Conversation c has the first h turns of c - c % share (all if fewer), then its own after its first h; h = crc32(c) % heads."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.substring(F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, WIDTH).alias("dig"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"))
    turns = stored(global_position(rows, ["conv", "turn", "dig"]), "trie-turns")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    own = turns.groupBy("conv").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n"))
    own = own.withColumns({"base": F.col("conv") - F.col("conv") % share, "h": h})
    have = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    itself = F.col("conv") == F.col("base")
    taken = F.when(itself, F.lit(0)).otherwise(F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = own.join(have, "base", "left").select("conv", "base", "first", "n", F.when(itself, F.lit(0)).otherwise(F.col("h")).alias("h"), taken.alias("taken"))
    convs = stored(convs.withColumn("len", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-convs")
    placed = turns.join(convs, "conv").withColumn("pos", F.col("position") - F.col("first"))
    kept = placed.where("pos >= h").select("conv", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "dig", "words")
    # At most heads - 1 turns of a base, for the few ids that share it.
    lent = placed.where((F.col("conv") == F.col("base")) & (F.col("pos") < heads - 1)).select("base", F.col("pos").alias("at"), "dig", "words")
    borrowed = convs.where("taken > 0").select("conv", "base", "taken").join(lent, "base").where("at < taken")
    return kept.unionByName(borrowed.select("conv", (F.col("at") + 1).alias("depth"), "dig", "words")), convs.select("conv", "len")


def _next(start: bytes, digest: bytes) -> bytes:
    """The prefix digest after a whole chunk."""
    return hashlib.sha256(start + digest).digest()[:WIDTH]


def _chunks(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv, k, more (1: not the last), d (digest of the chunk), digs, words, total, start (digest of the prefix before), s_all (words from here on)."""
    k = F.floor((F.col("depth") - 1) / CHUNK).cast("long")
    packed = turns.groupBy("conv", k.alias("k")).agg(F.sort_array(F.collect_list(F.struct("depth", "dig", "words"))).alias("t"))
    none = convs.where("len = 0").select("conv", F.lit(0).cast("long").alias("k"), F.expr("cast(array() as array<struct<depth:bigint,dig:binary,words:bigint>>)").alias("t"))
    rows = packed.unionByName(none).join(convs, "conv").select(
        "conv", "k", (F.col("len") > (F.col("k") + 1) * CHUNK).cast("int").alias("more"), (F.col("len") > CHUNK).alias("long"),
        F.unhex(F.sha2(F.array_join(F.transform("t.dig", F.hex), "").cast("binary"), 256)).alias("d"), F.col("t.dig").alias("digs"), F.col("t.words").alias("words"),
        F.aggregate("t.words", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))
    rows = stored(rows, "trie-chunks")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, start = None, ROOT
        for b in batches:
            starts = []
            for conv, _, d in zip(*(c.to_pylist() for c in b.columns)):
                start = start if conv == last else ROOT
                last = conv
                starts.append(start)
                start = _next(start, d)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(starts, pa.binary())], ["conv", "k", "start"])

    later = Window.partitionBy("conv").orderBy(F.col("k").desc())
    many = rows.where("long").withColumn("s_all", F.sum("total").over(later))
    # One digest of a chunk each, for conversations of more than one chunk only.
    starts = rows.where("long").select("conv", "k", "d").repartition("conv").sortWithinPartitions("conv", "k").mapInArrow(chain, "conv long, k long, start binary")
    one = rows.where("NOT long").withColumns({"s_all": F.col("total"), "start": F.lit(ROOT)})
    return one.unionByName(many.join(starts, ["conv", "k"]))


def common_entries(a: bytes, b: bytes) -> int:
    """Entries that two sequences of prefix digests share; equal ones come first, so halving finds the last."""
    lo, hi = 0, min(len(a), len(b)) // WIDTH
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[(mid - 1) * WIDTH:mid * WIDTH] == b[(mid - 1) * WIDTH:mid * WIDTH]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _sums(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def _new_words(words: bytes, shared: int) -> int:
    """Words of a chunk's turns after its first ``shared``; ``words`` are running sums."""
    w = _sums(words)
    return int(w[-1] - (w[shared - 1] if shared > 0 else 0)) if len(w) else 0


def _sorted(chunks: DataFrame) -> DataFrame:
    """The stored chunks in order of their sequences, with their common prefix with both neighbours."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, words = [], []
            for start, d, digs, counts in zip(*(c.to_pylist() for c in b.columns[:4])):
                at, chain = start, []
                for x in digs:
                    at = hashlib.sha256(at + x).digest()[:WIDTH]
                    chain.append(at)
                if len(chain) == CHUNK:
                    chain[-1] = _next(start, d)
                keys.append(b"".join(chain))
                words.append(np.cumsum(counts, dtype=np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[4:], b.column(0), pa.array(keys, pa.binary()), pa.array(words, pa.binary())],
                                             ["conv", "k", "more", "total", "s_all", "start", "key", "words"])

    columns = "conv long, k long, more int, total long, s_all long, start binary, key binary, words binary"
    rows = chunks.select("start", "d", "digs", "words", "conv", "k", "more", "total", "s_all").mapInArrow(keyed, columns)
    spark = rows.sparkSession
    order = ["k", "start", "key", "more", "conv"]
    rows = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds part, seq and the edge to either neighbour (-1: another prefix; null: in another partition)."""
        from pyspark import TaskContext

        part, seq, last = TaskContext.get().partitionId(), 0, None

        def out(held: list[dict], more: dict | None) -> pa.RecordBatch:
            nonlocal seq, last
            for i, r in enumerate(held):
                then = held[i + 1] if i + 1 < len(held) else more
                r |= {"part": part, "seq": seq, "lft": edge(last, r), "rgt": edge(r, then)}
                r["new"] = None if last is None else _new_words(r["words"], r["lft"])
                seq, last = seq + 1, r
            return pa.RecordBatch.from_pylist(held, shape)

        def edge(a: dict | None, b: dict | None) -> int | None:
            if a is None or b is None:
                return None
            return common_entries(a["key"], b["key"]) if a["k"] == b["k"] and a["start"] == b["start"] else -1

        shape = pa.schema([*[(n, pa.int64()) for n in ("conv", "k")], ("more", pa.int32()), ("total", pa.int64()), ("s_all", pa.int64()), ("start", pa.binary()),
                           ("key", pa.binary()), ("words", pa.binary()), *[(n, pa.int64()) for n in ("part", "seq", "lft", "rgt", "new")]])
        held: list[dict] = []
        for b in batches:
            now = b.to_pylist()
            if held and now:
                yield out(held, now[0])
            held = now or held
        if held:
            yield out(held, None)

    return stored(rows.mapInArrow(neighbours, columns + ", part long, seq long, lft long, rgt long, new long"), "trie-sorted")


def _across(spark, rows: DataFrame) -> DataFrame:
    """(part, edge to the partition before, edge to the one after, new words of the first row): from the first and last row of each partition."""
    ends = rows.where("lft IS NULL OR rgt IS NULL").select("part", "lft", "rgt", "k", "start", "key", "words").orderBy("part", "seq").collect()
    by: dict[int, list] = {}
    for r in ends:
        by.setdefault(r["part"], []).append(r)
    parts, edges = sorted(by), [-1]
    for p, q in zip(parts, parts[1:]):
        a, b = by[p][-1], by[q][0]
        edges.append(common_entries(bytes(a["key"]), bytes(b["key"])) if (a["k"], a["start"]) == (b["k"], b["start"]) else -1)
    edges.append(-1)
    return spark.createDataFrame([(p, edges[i], edges[i + 1], _new_words(bytes(by[p][0]["words"]), edges[i])) for i, p in enumerate(parts)],
                                 "part long, before long, after long, first_new long")


def forest(items: list[dict]) -> tuple[list[dict], list[dict]]:
    """(nodes, open items) of neighbouring items: rows of one partition, or contracted components of several.

    An item has its edge to the item before and after (``lft``, ``rgt``; -1: none) and the sums of its members."""
    n = len(items)
    edge = [x["lft"] for x in items] + [items[-1]["rgt"]]
    boss, lo, hi = list(range(n)), list(range(n)), list(range(n))
    top = [len(x["key"]) // WIDTH for x in items]
    open_edge = [False] * (n + 1)
    open_edge[0], open_edge[n] = edge[0] >= 0, edge[n] >= 0
    nodes: list[dict] = []

    def find(i: int) -> int:
        while boss[i] != i:
            boss[i] = boss[boss[i]]
            i = boss[i]
        return i

    def close(i: int, above: int) -> None:
        """The nodes of component i from its top up to, not with, depth ``above``."""
        x = items[i]
        before = _sums(x["words"])
        for e in range(top[i], above, -1):
            pre = int(before[e - 2]) if e > 1 else 0
            nodes.append({"depth": x["k"] * CHUNK + e, "hash": x["key"][(e - 1) * WIDTH:e * WIDTH] if e else x["start"],
                          "parent": x["key"][(e - 2) * WIDTH:(e - 1) * WIDTH] if e > 1 else x["start"] if e else None, "conv": x["least"], "n_convs": x["n"],
                          "leaves": x["s_leaf"], "saved": x["s_all"] - x["n"] * pre - (x["s_new"] - x["own_new"] + x["own_all"] - pre)})
        top[i] = min(top[i], max(above, 0))

    for i in sorted((i for i in range(1, n) if edge[i] >= 0), key=lambda i: -edge[i]):
        d, a, b = edge[i], find(i - 1), find(i)
        left, right = lo[a], hi[b] + 1
        if (open_edge[left] and edge[left] > d) or (open_edge[right] and edge[right] > d):
            open_edge[i] = True
            continue
        close(a, d)
        close(b, d)
        # The leftmost item stands for the component: its own words count from the node on.
        boss[b], hi[a] = a, hi[b]
        x, y = items[a], items[b]
        for key in ("n", "s_all", "s_new", "s_leaf"):
            x[key] += y[key]
        x["least"] = min(x["least"], y["least"])
    left_open: list[dict] = []
    for i in range(n):
        if boss[i] != i:
            continue
        x, before, after = items[i], edge[lo[i]], edge[hi[i] + 1]
        above = max(before, after)
        # The root of the first chunks is a node; those of later chunks are the ends of the chunk before.
        close(i, above if above >= 0 else 0 if x["k"] else -1)
        if above >= 0:
            x |= {"lft": before, "rgt": after, "seq": len(left_open), "key": x["key"][:above * WIDTH], "words": x["words"][:above * 8]}
            left_open.append(x)
    return nodes, left_open


def _merged(items: DataFrame, group, name: str) -> tuple[DataFrame, DataFrame]:
    """One round of forests over groups of items: stored nodes, and the items left open."""
    names = [c.split()[0] for c in ITEM.split(", ")]
    node_names = [c.split()[0] for c in NODE.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    shape = pa.schema([("grp", pa.int64()), ("open", pa.bool_()), *[(c.split()[0], kinds[c.split()[1]]) for c in (ITEM + ", " + NODE).split(", ")]])

    def run(key: tuple, t: pa.Table) -> pa.Table:
        rows = sorted(t.select(names).to_pylist(), key=lambda r: (r["part"], r["seq"]))
        nodes, left = forest(rows)
        number = key[0].as_py()
        return pa.Table.from_pylist([{"grp": number, "open": False, **x} for x in nodes] + [{"grp": number, "open": True, **x, "part": number} for x in left], shape)

    done = stored(items.select(*names, group.alias("grp")).groupBy("grp").applyInArrow(run, f"grp long, open boolean, {ITEM}, {NODE}"), name)
    return done.where("NOT open").select(*node_names), done.where("open").select(*names)


def _ends(rows: DataFrame) -> DataFrame:
    """hash, sha: digest of the ids, in order, of the conversations that end at a node."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.when(F.length("key") == 0, F.col("start")).otherwise(F.substring("key", -WIDTH, WIDTH))
    ends = rows.where("more = 0").select(last.alias("hash"), "conv").repartitionByRange(n, "hash", "conv").sortWithinPartitions("hash", "conv")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size = None, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([int(ids[0])]), pa.array([",".join(ids)])], ["hash", "first", "ids"])

        for b in batches:
            for h, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (h != node or size > PACK_CHARS):
                    yield out()
                    ids, size = [], 0
                node = h
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for b in batches:
            hashes, digests = [], []
            for h, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if h != node:
                    if sha is not None:
                        hashes.append(node)
                        digests.append(sha.hexdigest())
                    node, sha = h, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), pa.array(digests, pa.string())], ["hash", "sha"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], ["hash", "sha"])

    packed = ends.mapInArrow(pack, "hash binary, first long, ids string")
    return packed.repartition(n, "hash").sortWithinPartitions("hash", "first").mapInArrow(digest, "hash binary, sha string")


def trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = ready(conversations.sparkSession)
    result = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    if conversations.where(F.col(f"`{conv_col}`").isNotNull()).isEmpty():
        return spark.createDataFrame([], result)
    rows = _sorted(_chunks(*rebuilt(conversations, conv_col, turn_col, role_col, text_col)))
    edged = rows.join(F.broadcast(_across(spark, rows)), "part").withColumns({
        "new": F.coalesce("new", "first_new"), "lft": F.coalesce("lft", "before"), "rgt": F.coalesce("rgt", "after")})
    leaf = ((F.col("more") == 0) & (F.col("rgt") < F.length("key") / WIDTH)).cast("long")
    edged = edged.select("part", "seq", "conv", "k", "start", "key", "words", "lft", "rgt", "more", "s_all", F.col("new").alias("own_new"),
                         F.col("total").alias("own_all"), leaf.alias("leaf"))
    alone = (F.col("k") == 0) & (F.col("more") == 0)
    later = Window.partitionBy("conv").orderBy(F.col("k").desc())
    summed = edged.where(alone).withColumns({"s_new": F.col("own_new"), "s_leaf": F.col("leaf")}).unionByName(
        edged.where(~alone).withColumns({"s_new": F.sum("own_new").over(later), "s_leaf": F.sum("leaf").over(later)}))
    items = summed.withColumns({"n": F.lit(1).cast("long"), "least": F.col("conv")})
    nodes, left = _merged(items, F.col("part"), "trie-forest")
    while not left.isEmpty():
        more, left = _merged(left, F.floor(F.col("part") / FAN).cast("long"), "trie-forest")
        nodes = nodes.unionByName(more)
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("hash")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("hash").alias("parent"), F.col("conv").alias("parent_conv_id"))
    out = nodes.join(children, "hash", "left").join(_ends(rows), "hash", "left").join(above, "parent", "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
