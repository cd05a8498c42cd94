"""Phrase collocations per language: broadcast double-array tries of Apriori-safe candidates.

Texts are read once: lower-cased (A-Z), cut into pieces and words, and packed by language into blocks of about ``BLOCK_TOKENS`` tokens, each with a dictionary of
its own. Word counts come from the dictionaries; only words that occur ``least`` times can stand in a candidate (Apriori), so they alone
get ids, one range of ids over all languages, and every other word becomes a break like the end of a piece.

Then level by level, n = 2 to 4. The phrases of n - 1 words are dealt into tries of at most ``TRIE_PHRASES``. Each trie becomes a double array
(``base``, ``check``), whose size this bounds, and is broadcast. A task takes the states of all positions of a block
at once through it, one level per numpy step, and at the end

* adds up ``bincount`` of the accepting states: the exact counts of the phrases of n - 1 words, and
* proposes what these phrases are followed by, where the phrase that starts one word later is also in the trie (Apriori). What a task proposes
  goes as sorted keys with counts held to ``least``: the sum over the tasks reaches ``least`` if and only if the phrase's count does.

Proposals that reach ``least`` are the next level's phrases, to be counted by its trie. Sums over the tasks go in rounds of ``FAN`` by ``FAN``
rows (tasks by key ranges), each of which cuts the ranges finer, so that the number of rows grows with the tasks and no row or group with the corpus.

Scores, absorption and ranks are joins and windows over the phrases that are left; quotients are of decimals, so they are exact beyond 64 bits.

Defined cases: a null text is empty; a null language is ``und``; every row counts, repeated ones too; words are compared by their bytes.
Fewer phrases than asked for are all returned; an empty table gives no rows. Other columns are left alone.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postwave.llm.blocks import pack, pack_sorted, unpack, unpack_sorted
from postwave.llm.common import encoded, ready, release, slices, stored
from postwave.operators.ranking import global_position

BLOCK_TOKENS = 2_000_000
#: Phrases of one trie: its arrays hold at most some tens of MB.
TRIE_PHRASES = 1_000_000
#: Proposals a task gathers before it sends them.
HELD_KEYS = 4_000_000
#: Rows of one round of sums, and key ranges that each round cuts; bits of a range.
FAN, RANGE_BITS = 64, 6
LONGEST = 4
DECIMAL = "decimal(38,0)"

#: A-Z to lower case; the ends of pieces (. , ; : ! ? and \x0A-\x0D) to \n, tab to blank.
_FOLD = bytes.maketrans(bytes(range(0x41, 0x5B)) + b".,;:!?\x0b\x0c\x0d\x09", bytes(range(0x61, 0x7B)) + b"\n" * 9 + b" ")
_SPREAD = 0x9E3779B97F4A7C15


def words_of(text: bytes) -> list[bytes]:
    """Words, and b"\\n" where a piece ends."""
    return [w for w in text.translate(_FOLD).replace(b"\n", b" \n ").split(b" ") if w]


def _blocks(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """The stored blocks: block, lang, words and counts (of its dictionary), codes (0: break, else place in the dictionary from 1)."""
    src = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[str, list] = {}

        def out(lang: str) -> pa.RecordBatch:
            nonlocal number
            places, parts, _ = held.pop(lang)
            number += 1
            codes = np.concatenate(parts)
            counts = np.bincount(codes, minlength=len(places))[1:]
            words = pa.array(list(places)[1:], pa.binary()).cast(pa.string())
            lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in (words, pa.array(counts.astype(np.int64)))]
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([lang]), *lists, pa.array([pack(codes)], pa.binary())], ["block", "lang", "words", "counts", "codes"])

        for part in (s for b in batches for s in slices(iter([b]), "text")):
            for lang, text in zip(part.column(1).to_pylist(), encoded(part, "text")):
                if lang not in held:
                    places: dict[bytes, int] = defaultdict()
                    places.default_factory = places.__len__
                    places[b"\n"] = 0
                    held[lang] = [places, [], 0]
                mine = held[lang]
                words = words_of(text)
                if words:
                    words.append(b"\n")
                    mine[1].append(np.fromiter(map(mine[0].__getitem__, words), np.int32, len(words)))
                    mine[2] += len(words)
                    if mine[2] >= BLOCK_TOKENS:
                        yield out(lang)
        for lang in [x for x, h in held.items() if h[2]]:
            yield out(lang)

    return stored(src.mapInArrow(run, "block long, lang string, words array<string>, counts array<long>, codes binary"), "phrase-blocks")


def _with_ids(blocks: DataFrame, frequent: DataFrame) -> DataFrame:
    """The stored blocks with the ids (from 1) of frequent words in place of dictionary codes: syms (sorted ids), codes (0: break)."""
    places = blocks.select("block", "lang", F.posexplode("words").alias("place", "word"))
    ids = places.join(frequent.select("lang", "word", "id"), ["lang", "word"]).groupBy("block").agg(
        F.collect_list("place").alias("places"), F.collect_list("id").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                codes = unpack(b.column(0)[i].as_py(), np.int32)
                places, ids = (b.column(c)[i].values.to_numpy() for c in (1, 2))
                order = np.argsort(ids)
                to = np.zeros(max(int(codes.max(initial=0)), int(places.max())) + 2, np.int32)
                to[places[order] + 1] = np.arange(1, len(ids) + 1)
                codes = to[codes]
                # One break is as good as many.
                codes = codes[(codes != 0) | (np.concatenate([[1], codes[:-1]]) != 0)]
                yield pa.RecordBatch.from_arrays([pa.array([pack_sorted(ids[order].astype(np.uint64))], pa.binary()), pa.array([pack(codes)], pa.binary())], ["syms", "codes"])

    joined = blocks.select("block", "codes").join(ids, "block").select("codes", "places", "ids")
    return stored(joined.mapInArrow(run, "syms binary, codes binary"), "phrase-texts")


class DoubleArray:
    """A trie of phrases of equal length: ``check[base[s] + x] == s`` where state s goes on with x, to state ``base[s] + x``.

    Words are numbered within the trie and spelt by the hexadecimal digits of their numbers (from 1), so that a state has 16 children at most, and
    its children a window of their own: the arrays are built by sorting alone and can't grow beyond a few slots per phrase."""

    def __init__(self, phrases: np.ndarray):
        """``phrases``: distinct rows of word ids."""
        self.symbols = np.unique(phrases)
        rows = np.searchsorted(self.symbols, phrases).astype(np.int64) + 1
        self.phrases, self.length = rows.shape
        self.digits = max(1, -(-int(len(self.symbols)).bit_length() // 4))
        # Slot 0 is the root; the slots up to 15 stay free, where the base 0 of accepting states leads.
        end, state, bases, checks = 16, np.zeros(len(rows), np.int64), [], []
        for level in range(self.length):
            for shift in range(4 * self.digits - 4, -1, -4):
                steps, back = np.unique(state * 16 + ((rows[:, level] >> shift) & 15), return_inverse=True)
                parents, digit = steps >> 4, steps & 15
                first = np.flatnonzero(np.diff(parents, prepend=-1))
                sizes = np.diff(np.append(first, len(steps)))
                widths = digit[first + sizes - 1] - digit[first] + 1
                base = end + np.cumsum(widths) - widths - digit[first]
                slots = np.repeat(base, sizes) + digit
                bases.append((parents[first], base))
                checks.append((slots, parents))
                end += int(widths.sum())
                state = slots[back]
        self.base, self.check, self.phrase = np.zeros(end + 16, np.int32), np.full(end + 16, -1, np.int32), np.full(end + 16, -1, np.int32)
        for at, base in bases:
            self.base[at] = base
        for at, parents in checks:
            self.check[at] = parents
        #: The phrase of an accepting state.
        self.phrase[state] = np.arange(len(rows))

    def step(self, state: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which states go on with the words x, and to which states (of those that do)."""
        alive = np.flatnonzero(x)
        state, x = state[alive], x[alive]
        for shift in range(4 * self.digits - 4, -1, -4):
            to = self.base[state] + ((x >> shift) & 15)
            goes = self.check[to] == state
            alive, state, x = alive[goes], to[goes], x[goes]
        return alive, state

    def accepted(self, syms: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The phrase (its number, or -1) that starts at each position; ``codes``: places in ``syms`` (sorted word ids) from 1, or 0.

        All positions advance at once, word by word; the first word's states are found once for each word of ``syms``."""
        place = np.minimum(np.searchsorted(self.symbols, syms), len(self.symbols) - 1)
        number = np.concatenate([[0], np.where(self.symbols[place] == syms, place + 1, 0)]).astype(np.int32)
        alive, state = self.step(np.zeros(len(number), np.int32), number)
        begin = np.zeros(len(number), np.int32)
        begin[alive] = state
        state = begin[codes]
        at = np.flatnonzero(state)
        state = state[at]
        for level in range(1, self.length):
            fits = at + level < len(codes)
            at, state = at[fits], state[fits]
            alive, state = self.step(state, number[codes[at + level]])
            at = at[alive]
        out = np.full(len(codes), -1, np.int32)
        out[at] = self.phrase[state]
        return out


def _spread(keys: np.ndarray, bits: int, back: bool = False) -> np.ndarray:
    """A bijection of the keys below 2^bits that spreads neighbours over all ranges (multiplication by an odd number)."""
    by = pow(_SPREAD, -1, 1 << bits) if back else _SPREAD % (1 << bits)
    with np.errstate(over="ignore"):
        return (keys.astype(np.uint64) * np.uint64(by)) & np.uint64((1 << bits) - 1)


def _ranges(keys: np.ndarray, counts: np.ndarray, bits: int, depth: int, kind: int, trie: int, sender: int, path: int = 0) -> list[tuple]:
    """Rows (kind, trie, path, sender, keys, counts): the sorted keys cut by their next ``RANGE_BITS`` bits below ``depth``."""
    shift = max(0, bits - RANGE_BITS * (depth + 1))
    edges = np.flatnonzero(np.diff((keys >> np.uint64(shift)).astype(np.int64), prepend=-1))
    out = []
    for lo, hi in zip(edges.tolist(), np.append(edges[1:], len(keys)).tolist()):
        at = int(keys[lo]) >> shift
        out.append((kind, trie, at, sender, pack_sorted(keys[lo:hi]), pack(counts[lo:hi])))
    return out


SENT = "kind int, trie int, path long, sender long, keys binary, counts binary"
COUNTED, PROPOSED = 0, 1


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["kind", "trie", "path", "sender", "keys", "counts"])


def _scan(texts: DataFrame, number: int, trie: DoubleArray, bits: int, n_words: int, least: int, only: bool, propose: bool) -> DataFrame:
    """One pass with one trie: counts of its phrases, and proposals of phrases one word longer.

    ``only``: the trie holds all phrases of its length, so what follows must be in it as well."""
    held = texts.sparkSession.sparkContext.broadcast(trie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        trie, sender = held.value, TaskContext.get().partitionId()
        counts = np.zeros(trie.phrases, np.int64)
        keys: list[np.ndarray] = []
        sums: list[np.ndarray] = []
        size = 0

        def proposals() -> pa.RecordBatch:
            k, c = _summed(np.concatenate(keys), np.concatenate(sums))
            keys.clear()
            sums.clear()
            return _batch(_ranges(k, np.minimum(c, least), bits, 0, PROPOSED, number, sender))

        for b in batches:
            for i in range(b.num_rows):
                syms = unpack_sorted(b.column(0)[i].as_py()).astype(np.int64)
                codes = unpack(b.column(1)[i].as_py(), np.int32)
                phrase = trie.accepted(syms, codes)
                at = np.flatnonzero(phrase >= 0)
                counts += np.bincount(phrase[at], minlength=len(counts))
                if not propose:
                    continue
                at = at[at + trie.length < len(codes)]
                after = codes[at + trie.length]
                fits = (after > 0) & ((phrase[at + 1] >= 0) if only else True)
                at, after = at[fits], after[fits]
                if len(at):
                    raw = phrase[at].astype(np.uint64) * np.uint64(n_words + 1) + syms[after - 1].astype(np.uint64)
                    k, c = np.unique(_spread(raw, bits), return_counts=True)
                    keys.append(k)
                    sums.append(np.minimum(c, least).astype(np.int64))
                    size += len(k)
                    if size > HELD_KEYS:
                        yield proposals()
                        size = 0
        if keys:
            yield proposals()
        found = np.flatnonzero(counts)
        if len(found):
            width = max(RANGE_BITS, int(len(counts)).bit_length())
            yield _batch(_ranges(found.astype(np.uint64), counts[found], width, 0, COUNTED, number, sender))

    return texts.mapInArrow(run, SENT)


def _merge(bits: int, widths: dict[int, int], least: int, depth: int, last: bool):
    """Sums the rows of one key range; unless it is the last round, cuts the range finer."""
    def merge(t: pa.Table) -> pa.Table:
        kind, trie, sender = (t.column(c)[0].as_py() for c in ("kind", "trie", "group"))
        keys, counts = _summed(np.concatenate([unpack_sorted(x) for x in t.column("keys").to_pylist()]),
                               np.concatenate([unpack(x, np.int64) for x in t.column("counts").to_pylist()]))
        if not last:
            counts = np.minimum(counts, least) if kind == PROPOSED else counts
            return pa.Table.from_batches([_batch(_ranges(keys, counts, bits if kind == PROPOSED else widths[trie], depth, kind, trie, sender))])
        fits = (counts >= least) | (kind == COUNTED)
        keys, counts = keys[fits], counts[fits]
        keys = _spread(keys, bits, back=True) if kind == PROPOSED else keys
        n = len(keys)
        return pa.table({"kind": pa.array([kind] * n, pa.int32()), "trie": pa.array([trie] * n, pa.int32()), "key": keys.astype(np.int64), "count": counts})

    return merge


def _gathered(sent: DataFrame, bits: int, widths: dict[int, int], tasks: int, least: int, name: str) -> DataFrame:
    """kind, trie, key, count: sums over all senders, of proposals only those that reach ``least``."""
    depth = 1
    while True:
        last = tasks <= FAN
        grouped = sent.withColumn("group", F.floor(F.col("sender") / FAN).cast("long")).groupBy("kind", "trie", "path", "group")
        merge = _merge(bits, widths, least, depth, last)
        if last:
            return stored(grouped.applyInArrow(merge, "kind int, trie int, key long, count long"), name)
        sent, tasks, depth = grouped.applyInArrow(merge, SENT), -(-tasks // FAN), depth + 1


def phrases(docs: DataFrame, least: int = 30, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang",
            trie_phrases: int = TRIE_PHRASES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words: id, lang, word, f of the frequent ones; phrases: w (ids), f, of 2 to ``longest`` words and f >= least; totals: lang, n)."""
    spark = ready(docs.sparkSession)
    blocks = _blocks(docs, text_col, lang_col)
    totals = blocks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    counted = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f"))
    words = stored(global_position(counted.where(F.col("f") >= least), ["lang", "word"]).withColumn("id", F.col("position") + 1).drop("position"), "phrase-words")
    n_words = words.count()
    empty = spark.createDataFrame([], "w array<long>, f long")
    if not n_words:
        return words, empty, totals
    texts = _with_ids(blocks, words)
    tasks = max(1, texts.rdd.getNumPartitions())
    level = words.select(F.array("id").alias("w"))
    found = empty
    for n in range(2, longest + 2):
        size = level.count()
        if not size:
            break
        n_tries = -(-size // trie_phrases)
        # A phrase's number is its place in its trie; a trie's phrases are few enough for one task's sort.
        level = level.withColumn("trie", F.pmod(F.xxhash64("w"), F.lit(n_tries)).cast("int"))
        level = stored(level.withColumn("at", F.row_number().over(Window.partitionBy("trie").orderBy("w")).cast("long") - 1), "phrase-level")
        propose = n <= longest
        next_level, counts = [], []
        for number in range(n_tries):
            # One bounded trie at a time: built on the driver, broadcast, released after its pass.
            named = level.where(F.col("trie") == number).select("at", "w")
            t = named.toArrow().combine_chunks()
            rows = np.array(t.column("w").combine_chunks().flatten()).reshape(-1, n - 1)[np.argsort(t.column("at").to_numpy())]
            built = DoubleArray(rows)
            bits = max(RANGE_BITS, int(len(rows) * (n_words + 1) + n_words).bit_length())
            width = {number: max(RANGE_BITS, len(rows).bit_length())}
            del t, rows
            sums = _gathered(_scan(texts, number, built, bits, n_words, least, n_tries == 1, propose), bits, width, tasks, least, "phrase-sums")
            if n > 2:
                counts.append(sums.where(F.col("kind") == COUNTED).join(named, F.col("key") == F.col("at")).select("w", F.col("count").alias("f")))
            if propose:
                ahead = sums.where(F.col("kind") == PROPOSED).select(F.floor(F.col("key") / (n_words + 1)).cast("long").alias("on"), (F.col("key") % (n_words + 1)).alias("id"))
                next_level.append(ahead.join(named, F.col("on") == F.col("at")).select(F.concat("w", F.array("id")).alias("w")))
        for part in counts:
            found = found.unionByName(part)
        if not propose:
            break
        level = next_level[0]
        for part in next_level[1:]:
            level = level.unionByName(part)
        release(spark)
    return words, stored(found, "phrases"), totals


def collocations(docs: DataFrame, least: int = 30, longest: int = LONGEST, top: int = 2000, text_col: str = "text", lang_col: str = "lang",
                 trie_phrases: int = TRIE_PHRASES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language by score (its lowest-scoring cut), then count, then bytes."""
    words, found, totals = phrases(docs, least, longest, text_col, lang_col, trie_phrases)
    d = lambda c: F.col(c).cast(DECIMAL)
    every = words.select(F.array("id").alias("w"), "f").unionByName(found)
    # Absorbed: a longer phrase around it occurs at least 0.8 times as often.
    inside = found.where(F.size("w") > 2).select("f", F.explode(F.expr(
        "flatten(transform(sequence(2, size(w) - 1), k -> transform(sequence(1, size(w) - k + 1), i -> slice(w, i, k))))")).alias("w"))
    longer = inside.groupBy("w").agg(F.max("f").alias("longer"))
    kept = found.join(longer, "w", "left").where(F.col("longer").isNull() | (F.lit(100).cast(DECIMAL) * d("longer") < F.lit(80).cast(DECIMAL) * d("f")))
    cuts = kept.select("w", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("cut")).select(
        "w", "a", "cut", F.expr("slice(w, 1, cut)").alias("head"), F.expr("slice(w, cut + 1, size(w) - cut)").alias("rest"))
    cuts = cuts.join(every.select(F.col("w").alias("head"), F.col("f").alias("l")), "head").join(every.select(F.col("w").alias("rest"), F.col("f").alias("r")), "rest")
    cuts = cuts.withColumn("score", F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    lowest = cuts.groupBy("w", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("x"))
    lang = words.select(F.col("id").alias("first"), "lang")
    scored = lowest.select("w", "a", "x.l", "x.r", "x.score", F.col("w")[0].alias("first")).join(lang, "first").drop("first")
    # All that can be among the first, ties included; only these get their words.
    by = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    near = scored.withColumn("at", F.rank().over(by)).where(F.col("at") <= top).drop("at")
    spelt = near.select("*", F.posexplode("w").alias("place", "id")).join(words.select("id", "word"), "id")
    spelt = spelt.groupBy("lang", "w", "a", "l", "r", "score").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("x"))
    spelt = spelt.select("lang", F.array_join("x.word", " ").alias("phrase"), "a", "l", "r", "score")
    ranked = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    out = spelt.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top).join(totals, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
