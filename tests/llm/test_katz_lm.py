"""The language model against a direct implementation over dictionaries, and its normalisation."""

import math
import random
import zlib
from collections import Counter

import pytest

from postwave.llm import katz_lm as lm

END, BEGIN, UNK = "</end>", "<begin>", "<unk>"


class Direct:
    """Katz backoff written out over dictionaries of tuples."""

    def __init__(self, texts, order):
        self.order, self.counts, self.d = order, {}, {}
        seqs = [[*t, END] for t in texts]
        for n in range(1, order + 1):
            c = Counter()
            for s in seqs:
                padded = [BEGIN] * (n - 1) + s
                c.update(tuple(padded[k:k + n]) for k in range(len(s)))
            self.counts[n] = c
            self.d[n] = lm.discounts([sum(v == r for v in c.values()) for r in range(1, lm.K + 2)])
        self.total = sum(self.counts[1].values())
        mass = sum(self.disc(1, v) for v in self.counts[1].values()) / self.total if self.total else 0
        self.unknown = max(1 - mass, 1 / (self.total + 1)) if self.total else 1.0
        self.scale = (1 - self.unknown) / mass if self.total else 1.0
        self.after = {n: {} for n in range(2, order + 1)}
        for n in range(2, order + 1):
            for g, v in self.counts[n].items():
                self.after[n].setdefault(g[:-1], {})[g[-1]] = v

    def disc(self, n, c):
        return float(self.d[n][min(c, lm.K + 1)]) * c

    def p(self, history, w):
        n = len(history) + 1
        if n == 1:
            c = self.counts[1].get((w,), 0)
            return self.disc(1, c) / self.total * self.scale if c else self.unknown
        seen = self.after[n].get(history)
        if seen is None:
            return self.p(history[1:], w)
        c = sum(seen.values())
        mass = sum(self.disc(n, v) for v in seen.values()) / c
        shrink = c / (c + 1) if mass >= 1 - 1e-12 else 1.0
        if w in seen:
            return self.disc(n, seen[w]) / c * shrink
        low = sum(self.p(history[1:], x) for x in seen)
        return (1 - mass * shrink) / (1 - low) * self.p(history[1:], w)

    def score(self, words):
        s = [BEGIN] * (self.order - 1) + [*words, END]
        return sum(math.log10(self.p(tuple(s[k:k + self.order - 1]), s[k + self.order - 1])) for k in range(len(words) + 1))


def corpus(n=120, seed=3):
    rnd = random.Random(seed)
    words = ["a", "B", "b", "é", "É", "the", "The"] + [f"w{k}" for k in range(40)]
    texts = [" ".join(rnd.choices(words, weights=[30, 20, 20, 9, 9, 40, 10] + [1] * 40, k=rnd.randint(0, 40))) for _ in range(n)]
    return [(k, t) for k, t in enumerate(texts)] + [(500, None), (501, ""), (502, "never seen zzz\tqqq\n a"), (503, "the the the the")]


def lower(t):
    return [w.decode() for w in (t or "").encode().lower().split()]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_matches_direct_model(spark, order):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lm.score(docs, order=order).collect()}
    train = [lower(t) for k, t in rows if zlib.crc32(str(k).encode()) % 10]
    m = Direct(train, order)
    assert len(got) == len(rows)
    v = len(m.counts[1])
    for k, t in rows:
        r, words = got[k], lower(t)
        assert r.held_out == (zlib.crc32(str(k).encode()) % 10 == 0)
        assert r.n_tokens == len(words) + 1 and r.train_tokens == m.total
        assert r.n_known == sum((w,) in m.counts[1] for w in [*words, END])
        base = sum(math.log10((m.counts[1].get((w,), 0) + 0.1) / (m.total + 0.1 * (v + 1))) for w in [*words, END])
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(m.score(words), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_direct_model_is_normalised(order):
    m = Direct([lower(t) for _, t in corpus()], order)
    vocabulary = [g[0] for g in m.counts[1]] + [UNK]
    for n in range(2, order + 1):
        for history in list(m.after[n])[:25]:
            assert sum(m.p(history, w) for w in vocabulary) == pytest.approx(1.0, abs=1e-9)


def test_split_histories_give_the_same_scores(spark):
    """A history that fills a bucket is dealt by word; its sums come together again."""
    rows = [(k, " ".join(["x", f"y{k % 37}"] * 30)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    m = Direct([lower(t) for k, t in rows if zlib.crc32(str(k).encode()) % 10], 2)
    for r in lm.score(docs).collect():
        assert r.score == pytest.approx(m.score(lower(dict(rows)[r.doc_id])), rel=1e-9)


def test_empty_table_clashing_columns_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(empty).collect() == []
    rows = [(k % 5, f"some words here {k % 5}", "x", 1.0) for k in range(20)] + [(None, "some words", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, score double")
    got = lm.score(docs).collect()
    assert len(got) == 21
    assert len({(r.doc_id, round(r.score, 9)) for r in got}) == 6
    assert not next(r for r in got if r.doc_id is None).held_out
