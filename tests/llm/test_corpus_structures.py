"""Collocations, the prefix trie and the kNN join against brute force, on small odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from postwave.llm import collocations, knn_join, prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- collocations

def brute_collocations(rows, least, top, longest=4):
    f, totals = defaultdict(Counter), Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        absorbed = {p[i:i + m] for p, a in cand.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= 80 * counts[p[i:i + m]]}
        scored = []
        for p, a in cand.items():
            if p in absorbed:
                continue
            score, _, left, right = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def phrase_rows():
    rnd = random.Random(3)
    vocab = ["Za", "lo", "né", "日本", "x\x01y", "a#b", "q", "The"]
    rows = [(rnd.choice(["de", "en", None, "a b"]), " ".join(rnd.choices(vocab, weights=range(8, 0, -1), k=rnd.randint(0, 30)))
             .replace("q", rnd.choice([".", "q,", "\t", "!? ", "q\r\nq"]))) for _ in range(120)]
    rows += [(None, None), ("en", ""), ("en", " \t .,"), ("fr", "one"), ("en", "la la la la la la"), ("en", "la la la la la la")]
    return rows + [("en", "hot line of words " * 400)]


@pytest.mark.parametrize("tries", [1_000_000, 7])
def test_collocations_against_counting(spark, tries):
    rows = phrase_rows()
    df = spark.createDataFrame([(t, x, "w", 1, "k") for x, t in rows], "text string, lang string, word string, f int, `a.b` string").repartition(5)
    got = collocations.collocations(df, least=4, top=40, trie_phrases=tries)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(rows, 4, 40)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(spark.createDataFrame([("a b a b", "en")], "text string, lang string")).collect() == []


def test_double_array_accepts_its_phrases_only():
    rnd = np.random.default_rng(5)
    for length, words in ((1, 40), (2, 12), (3, 300), (4, 5)):
        phrases = np.unique(rnd.integers(10, 10 + words, (200, length)), axis=0)
        trie = collocations.DoubleArray(phrases)
        syms = np.arange(8, 12 + words)
        codes = rnd.integers(0, len(syms) + 1, 3000).astype(np.int32)
        found = trie.accepted(syms, codes)
        known = {tuple(p): i for i, p in enumerate(phrases.tolist())}
        text = [int(syms[c - 1]) if c else None for c in codes]
        assert found.tolist() == [known.get(tuple(text[i:i + length]), -1) for i in range(len(text))]


def test_sums_in_several_rounds_keep_all(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FAN", 2)
    rows = phrase_rows()
    df = spark.createDataFrame([(t, x) for x, t in rows], "text string, lang string").repartition(7)
    monkeypatch.setattr(collocations, "BLOCK_TOKENS", 50)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        got = collocations.collocations(df, least=4, top=40)
        assert sorted(tuple(r) for r in got.collect()) == brute_collocations(rows, 4, 40)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


# ---- prefix trie

def brute_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            r, t = role or "", text or ""
            dig = hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()[:16]
            convs[conv].append((turn is not None, turn or 0, dig, r, t))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in convs.items()}
    seqs = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = turns.get(c - c % 20, [])[:h] + turns[c][h:]
    members, kids = defaultdict(set), defaultdict(set)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].add(c)
            if d:
                kids[tuple(s[:d - 1])].add(tuple(s[:d]))
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) if p else 0)
    ends = defaultdict(list)
    for c in sorted(seqs):
        ends[tuple(seqs[c])].append(str(c))
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(ends[p]).encode()).hexdigest()) for p, m in members.items())


def conversation_rows(seed, n=150):
    rnd = random.Random(seed)
    texts = ["a b", "c", None, "", "d e f", "a  b"]
    rows = []
    for c in rnd.sample(range(400), n):
        for t in range(rnd.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, rnd.choice(["user", "user", None]), rnd.choice(texts[:rnd.choice([1, 2, 6])])))
    rows += [(1000 + 20 * i, t, "u", "same words here") for i in range(30) for t in range(4)]
    rows += [(5, None, "u", "first"), (5, 3, "u", "tie"), (5, 3, "u", "tie"), (None, 1, "u", "lost"), (7, 1, "u", "x" * 100_000)]
    return rows


def trie_rows(spark, rows, parts=5):
    df = spark.createDataFrame([(*r, "k", "h") for r in rows], "conv_id long, turn long, role string, text string, key string, hash string").repartition(parts)
    out = prefix_trie.trie(df).collect()
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                   r["saved_tokens"], r["ends_sha256"]) for r in out)


@pytest.mark.parametrize("chunk,fan", [(512, 32), (3, 2)])
def test_trie_against_sets_of_prefixes(spark, monkeypatch, chunk, fan):
    monkeypatch.setattr(prefix_trie, "FAN", fan)
    monkeypatch.setattr(prefix_trie, "PACK_CHARS", 20)
    if chunk == 3:
        # Chunk length is a constant of the module that workers import, so long conversations take its place.
        rows = conversation_rows(2, 60) + [(c, t, "u", f"w{t if c < 2000 or t < 900 else c}") for c in (1980, 1981, 2000, 2001) for t in range(1300)]
    else:
        rows = conversation_rows(1)
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).collect() == []
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "u", "t")], schema)).collect() == []


def test_forests_of_parts_equal_the_whole():
    """However sorted sequences are cut into partitions and the contracted forests merged, the nodes are the same."""
    rnd = random.Random(11)
    for _ in range(200):
        seqs = sorted(tuple(rnd.choice("ab") for _ in range(rnd.randint(0, 5))) for _ in range(rnd.randint(1, 25)))
        digest = lambda s: hashlib.sha256(repr(s).encode()).digest()[:16]
        keys = [b"".join(digest(s[:d + 1]) for d in range(len(s))) for s in seqs]
        edges = [-1] + [prefix_trie.common_entries(a, b) for a, b in zip(keys, keys[1:])] + [-1]

        def items():
            for i, s in enumerate(seqs):
                words = np.arange(1, len(s) + 1, dtype=np.int64)
                own = len(s) - max(edges[i], 0)
                yield {"part": 0, "seq": i, "k": 0, "start": prefix_trie.ROOT, "key": keys[i], "words": words.tobytes(), "lft": edges[i], "rgt": edges[i + 1], "n": 1,
                       "least": i, "s_all": len(s), "s_new": own, "s_leaf": int(edges[i + 1] < len(s)), "own_new": own, "own_all": len(s)}

        whole, left = prefix_trie.forest(list(items()))
        assert not left
        rows, nodes = list(items()), []
        while rows:
            cuts = sorted(rnd.sample(range(1, len(rows)), min(len(rows) - 1, rnd.randint(0, 6)))) if len(rows) > 1 else []
            parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
            rows = []
            for p in parts:
                done, still = prefix_trie.forest(p)
                nodes += done
                rows += still
        order = lambda x: (x["depth"], x["hash"])
        assert sorted(nodes, key=order) == sorted(whole, key=order)


# ---- kNN join

def brute_search(rows, k=5):
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in good), default=0)
    mat = [[int(np.floor(256.0 * float(np.float64(x)))) for x in v] + [0] * (dim - len(v)) for _, v in good]
    out = []
    for a, (i, _) in enumerate(good):
        if i is None or i % 50:
            continue
        scores = sorted((-sum(x * y for x, y in zip(mat[a], mat[b])), j is None, j or 0) for b, (j, _) in enumerate(good) if b != a)
        out += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def found(spark, rows, kind="float"):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, score int, row int").repartition(4)
    from pyspark.sql import functions as F
    return sorted((tuple(r) for r in knn_join.search(df, F.col("vec_id") % 50 == 0).collect()), key=str)


def vectors(seed=1, n=400, dim=6):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(5, dim))
    rows = [(i, (centres[i % 5] + 0.1 * rnd.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)] + [(50, rows[3][1]), (50, rows[4][1]), (None, rows[3][1])]
    return rows + [(2000, None), (2050, [1.0, None] + [0.0] * (dim - 2)), (2100, [float("nan")] * dim), (2150, [float("inf")] + [0.0] * (dim - 1)), (2200, []), (2250, [0.5, -0.5])]


def test_search_against_all_pairs(spark, monkeypatch):
    assert found(spark, vectors()) == brute_search(vectors())
    monkeypatch.setattr(knn_join, "SPLIT_ROWS", 100)
    monkeypatch.setattr(knn_join, "CUT_QUERIES", 3)
    assert found(spark, vectors(2)) == brute_search(vectors(2))


def test_search_of_few_and_none(spark):
    assert found(spark, []) == [] and found(spark, [(1, [0.5])]) == [] and found(spark, [(0, [0.5])]) == []
    assert found(spark, [(0, [0.5]), (1, [-0.25])]) == [(0, 1, 1, -128 * 64)]


def test_search_beyond_doubles_and_longs(spark):
    rows = [(0, [3.0e6, 1.0]), (1, [3.0e6, 0.0]), (2, [3.0e6, 1 / 256])]
    assert found(spark, rows, "double") == brute_search(rows)
    top = (1 << 63) - 1
    assert found(spark, [(0, [1e300]), (1, [1e300]), (2, [-1e300])], "double") == [(0, 1, 1, top), (0, 2, 2, -top - 1)]


def test_bounds_leave_out_far_cells_only():
    rnd = np.random.default_rng(4)
    pivots = np.array([[100.0, 0, 0], [-100.0, 0, 0], [0, 100.0, 0]])
    data = np.concatenate([p + rnd.normal(scale=3, size=(200, 3)) for p in pivots])
    cell, dist = knn_join._nearest(data, pivots)
    cells = {j: sorted(dist[cell == j])[:6] for j in range(3)}
    centre, radius = pivots[0], 5.0
    least = knn_join.least_distances(pivots, cells, centre, radius, 5)
    needed = dist >= least[cell]
    assert needed[cell == 0].any() and not needed[cell == 1].any()
    for q in centre + rnd.normal(size=(50, 3)):
        best = np.argsort(-(data @ q))[:6]
        assert needed[best].all()
