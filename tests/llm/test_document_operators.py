"""Quality rules, line chunks, near-duplicates, decontamination, importance and tokens against brute force."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import zstandard

from postwave.llm import importance, line_chunks, near_dup, quality_rules, sentencepiece_bpe, template_decontam
from postwave.llm.common import SLICE_BYTES

SF = "/root/testdata/sf0.001"
MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = "doc_id long, text string, kept string, digest string, h string, n_words string, block string, class_id string, `a.b` string"


def odd_rows():
    """Nulls, empty and blank texts, repeats, a very long text and one long word."""
    rnd = random.Random(7)
    vocab = [f"{a}{b}" for a in ("za", "né", "tho", "kir", "日本") for b in ("lo", "mi", "ran", "x")]
    prose = lambda n: " ".join(rnd.choices(vocab, k=n))
    rows = [(1, None), (2, ""), (3, " \n\t \n"), (4, "one"), (5, prose(60)), (6, "a\nb\na\n\n c \na"), (None, prose(30)), (None, None),
            (7, "same line here and there\n" * 40), (8, "x" * 5000), (9, "\n".join(prose(12) for _ in range(30))), (10, " ".join(["w"] * 9)),
            (11, "*#$ <a> | & % x" * 5), (12, "tab\x0bvt\x0cff\rcr nbsp in word \U0001f600 " * 4), (13, prose(40_000))]
    rows += [rows[4], (50, rows[4][1]), (51, rows[4][1]), (52, rows[10][1])]
    return rows


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "k", "d", "h", "n", "b", "c", "ab") for i, t in rows], ODD)


def base_measures(text):
    t = text or ""
    words = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    count = Counter(windows)
    hit = {k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(hit)


def test_quality_rules(spark):
    rows = odd_rows()
    got = quality_rules.judge(clashing(spark, rows)).collect()
    assert len(got) == len(rows)
    zstd, bands = zstandard.ZstdCompressor(level=3), quality_rules.Bands()
    want = Counter()
    for i, t in rows:
        m = base_measures(t)
        failed = m[0] < 20 or 100 * m[4] > 30 * m[0]
        raw = (t or "").encode()
        kept = not failed
        if raw:
            limit = [r for r in bands.whole if r[0] <= len(raw)]
            kept &= not limit or limit[-1][1] <= len(zstd.compress(raw)) / len(raw) <= limit[-1][2]
            for k in range(0, len(raw) - 4095, 4096):
                kept &= 0.28 <= len(zstd.compress(raw[k:k + 4096])) / 4096 <= 0.72
        want[(i, *m, failed, kept)] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got) == want


def test_quality_rules_bands_and_stage(spark):
    rnd = random.Random(1)
    noise = " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=60)) for _ in range(90))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = docs.where("doc_id = 5").first().text
    rows = [(1, noise), (2, clean)]
    assert {r.doc_id: r.kept for r in quality_rules.judge(clashing(spark, rows)).collect()} == {1: False, 2: True}
    kept = quality_rules.filter_stage(clashing(spark, rows))
    assert kept.columns == clashing(spark, rows).columns and [r.doc_id for r in kept.collect()] == [2]
    assert quality_rules.judge(clashing(spark, [])).collect() == []


def test_quality_rules_judge_the_end_of_a_text(spark):
    rnd = random.Random(4)
    clean = " ".join(r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()).encode("ascii", "ignore").decode()[:4097]
    noise = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=4095))
    bands, zstd = quality_rules.Bands(), zstandard.ZstdCompressor(level=3)
    for tail, k in ((noise, 2), ("buy now here " * 192, 1)):
        whole, *chunk, good = quality_rules.ratios((clean + tail).encode(), bands, zstd)
        assert not good and not bands.chunk[0] <= chunk[k - 1] <= bands.chunk[1]
        assert bands.whole[-2][1] <= whole <= bands.whole[-2][2]             # the whole text doesn't show it


def test_labelled_good_documents_are_kept(spark):
    d = quality_rules.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = d.join(labels, "doc_id").where("quality = 1 and not base_failed").selectExpr("avg(int(kept)) as share").first()
    assert got.share == 1.0


def test_tokens_equal_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rnd = random.Random(2)
    alpha = [*"aabbtheinoer  ▁\n\t\r.é日\x00\x01<0x0A>", "the", "tion", "   ", " " * 17, "€", "\U0001f600"]
    rows = odd_rows() + [(100 + k, "".join(rnd.choices(alpha, k=rnd.randint(0, 50)))) for k in range(800)]
    rows += [(5000, " " * 100), (5001, "x" + " " * 33 + "y"), (5002, "\n\n"), (5003, "</s><s>"), (5004, "a" * 3000)]
    rows += [(r.doc_id + 10_000, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    got = sentencepiece_bpe.encode_decode(clashing(spark, rows), MODEL, with_ids=True, with_text=True).collect()
    want = Counter()
    for i, t in rows:
        ids = sp.encode(t or "", add_eos=True)
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest(), tuple(ids), sp.decode(ids)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids), r.decoded) for r in got) == want
    assert sentencepiece_bpe.encode_decode(clashing(spark, []), MODEL).collect() == []


def test_coder_starts_anew_when_its_table_is_full():
    coder = sentencepiece_bpe.Coder(sentencepiece_bpe.load(MODEL), kept=5)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in ("one two three four five six seven", "eight nine ten", "one two"):
        (parts,) = coder.encode([text])
        assert [int(x) for x in " ".join(parts).split()] == sp.encode(text) and coder.model.decode(" ".join(parts).split()) == text


def lines_of(text):
    return [x for x in (text or "").split("\n") if x and not x.isspace()]


def test_decoding_of_ids_made_by_hand():
    """Broken byte runs, unknown and control ids, leading blanks: the text comes from the ids alone, as the library's."""
    model = sentencepiece_bpe.load(MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rnd = random.Random(3)
    kinds = [range(sp.get_piece_size()), *[[int(i) for i in x] for x in (model.byte_of, model.byte_of, model.silent, model.blank_first)], [model.unk]]
    for _ in range(5000):
        ids = [rnd.choice(rnd.choice(kinds)) for _ in range(rnd.randint(0, 9))]
        assert model.decode([str(i) for i in ids]) == sp.decode(ids)


def test_line_chunks_remove_repeats_and_nothing_else(spark):
    rnd = random.Random(5)
    own = lambda d, k: f"own line {d} {k} {rnd.random()}"
    passage = [f"shared line number {k} of the passage" for k in range(8)]
    rows = []
    for d in range(40):
        body = [own(d, k) for k in range(6)]
        cut = rnd.randint(0, 6)
        rows.append((d, "\n".join(body[:cut] + (passage if d % 2 else []) + body[cut:])))
    rows += [(100, None), (101, ""), (102, "single"), (103, "\n \n\n"), (3, rows[3][1]), (None, "\n".join(passage))]
    src = clashing(spark, rows)
    got = line_chunks.dedup(src)
    assert got.columns == [*src.columns, "__removed"]
    out = got.collect()
    assert len(out) == len(rows)
    before = Counter(x for _, t in rows for x in lines_of(t))
    after = Counter(x for r in out for x in lines_of(r.text))
    assert set(after) == set(before)                                    # each line survives somewhere
    assert all(after[x] == n for x, n in before.items() if n == 1)      # lines met once all stay
    assert sum(after[x] for x in passage) <= 0.5 * sum(before[x] for x in passage)
    by_id = {r.doc_id: r.text for r in out}
    assert by_id[100] is None and by_id[101] == "" and by_id[102] == "single" and by_id[103] == "\n \n\n"
    assert by_id[None] == "\n".join(passage)                            # the least id comes first


def direct_line_dedup(rows):
    """The rule of line_chunks over lists: anchors, occurrences that go, extension beside them."""
    docs = sorted({(i is not None, i or 0, t) for i, t in rows if t is not None})
    lines = {d: lines_of(d[2]) for d in docs}
    met = {}
    for d in docs:
        for a, b, h in line_chunks.anchors(*line_chunks.line_table(d[2])):
            met.setdefault(h, []).append((d, a, b))
    gone = {d: set() for d in docs}
    pairs = []
    for found in met.values():
        for d, a, b in sorted(found, key=lambda x: (x[0][:2], x[1]))[1:]:
            gone[d].update(range(a, b))
            pairs.append((min(found, key=lambda x: (x[0][:2], x[1])), (d, a, b)))
    more = {d: set() for d in docs}
    for (kd, ka, kb), (d, a, b) in pairs:
        for k, at, step in ((ka - 1, a - 1, -1), (kb, b, 1)):
            n = 0
            while 0 <= k < len(lines[kd]) and 0 <= at < len(lines[d]) and at not in gone[d] and n < line_chunks.LEAST_WORDS and lines[kd][k] == lines[d][at]:
                more[d].add(at)
                n += len(lines[d][at].split())
                k, at = k + step, at + step
    return {(d[1] if d[0] else None, d[2]): [x for k, x in enumerate(lines[d]) if k not in gone[d] and k not in more[d]] for d in docs}


def passage_rows(seed, sizes):
    rnd = random.Random(seed)
    planted = [[f"passage {n} {g} line {k} " + "and more " * (g % 2) for k in range(n)] for n in sizes for g in range(6)]
    planted += [[" ".join(f"long{g}w{k}" for k in range(51))] for g in range(6)]
    rows = []
    for p in planted:
        for _ in range(3):
            own = [f"own {rnd.random()} line {rnd.random()}" for _ in range(6)]
            cut = rnd.randint(0, 6)
            rows.append((len(rows), "\n".join(own[:cut] + p + own[cut:])))
    return planted, rows + [(1000, planted[-1][0]), (1001, "short line\nx"), (1002, "y\nshort line\nz")]


def test_line_chunks_remove_every_line_of_passages_of_twenty_words(spark):
    planted, rows = passage_rows(9, (4, 5, 8, 30))
    out = line_chunks.dedup(clashing(spark, rows)).collect()
    after = Counter(x for r in out for x in lines_of(r.text))
    before = Counter(x for _, t in rows for x in lines_of(t))
    gone = {x for p in planted for x in p}
    assert after == Counter({x: 1 if x in gone else n for x, n in before.items()})


def test_line_chunks_against_lists(spark):
    rnd = random.Random(4)
    rows = passage_rows(3, (2, 3, 4, 6))[1]
    pool = [" ".join(rnd.choices("a b c dd ee ff".split(), k=rnd.randint(1, 9))) for _ in range(12)]
    rows += [(2000 + k, "\n".join(rnd.choice(pool) + rnd.choice(["", "", "\n\n"]) for _ in range(rnd.randint(1, 40)))) for k in range(40)]
    rows += [(2000, rows[-3][1]), (None, rows[-5][1]), (3000, "same line here and there\n" * 40)]
    want = direct_line_dedup(rows)
    got = line_chunks.dedup(clashing(spark, rows)).collect()
    for r, n in Counter((r.doc_id, r.text) for r in got).items():
        assert [x for i, t in rows if i == r[0] for x in [want[i, t]]].count(lines_of(r[1])) >= n
    assert len(got) == len(rows)


def test_line_chunks_leave_short_generic_lines(spark):
    own = lambda d: "\n".join(f"own words {d} {k} of this text" for k in range(3))
    rows = [(d, f"{own(d)}\n{pair}\n{own(-d)}") for d, pair in enumerate(["Yes.\nNo.", "Yes.\nNo.", "  }\n}", "  }\n}"], 1)]
    assert {r.doc_id: r.text for r in line_chunks.dedup(clashing(spark, rows)).collect()} == dict(rows)


def test_line_chunk_boundaries_resist_shifts():
    rnd = random.Random(2)
    lines = [f"line {rnd.random()}" for _ in range(400)]
    digests = lambda some: line_chunks.line_table("\n".join(some))[0]
    ends = set(line_chunks.boundaries(digests(lines), 400))
    for extra in range(1, 6):
        moved = {e - extra for e in line_chunks.boundaries(digests([f"new {k}" for k in range(extra)] + lines), 400 + extra)}
        assert {e for e in ends if e > 40} == {e for e in moved if e > 40}


def test_line_chunks_of_equal_hash_but_other_bytes_stay(spark, monkeypatch):
    same = "\n".join(f"{x} words of a line that is long enough" for x in "abc")
    rows = [(1, same), (2, same), (3, "g h\ni j")]
    src = clashing(spark, rows)
    marked = line_chunks.repeats(src)
    assert line_chunks.unequal(marked, "text").collect() == []
    forged = marked.withColumn("text", marked.text).selectExpr("*").replace(same, "x\ny\nz", "text").where("doc_id = 2")
    assert line_chunks.unequal(forged.unionByName(marked.where("doc_id = 1")), "text").count() >= 1
    assert line_chunks.dedup(clashing(spark, [])).collect() == []


def brute_classes(rows, similarity=0.8):
    texts = sorted({t or "" for _, t in rows})
    doc, h, tf = near_dup.shingles([t.encode() for t in texts])
    df = Counter(h.tolist())
    w = near_dup.weigh(__import__("numpy").array([df[x] for x in h.tolist()]), tf, len(texts))
    vec = [{} for _ in texts]
    for a, b, c in zip(doc.tolist(), h.tolist(), w.tolist()):
        vec[a][b] = c
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            common = sum(min(x, vec[b][k]) for k, x in vec[a].items() if k in vec[b])
            union = sum(vec[a].values()) + sum(vec[b].values()) - common
            if union and common / union >= similarity - 1e-9:
                root[find(a)] = find(b)
    members = {}
    for i, t in rows:
        members.setdefault(find(texts.index(t or "")), set()).add(i)
    return {frozenset(v) for v in members.values()}


def test_near_duplicates_match_brute_force(spark):
    rnd = random.Random(11)
    vocab = [f"w{k}" for k in range(400)]
    rows = []
    for g in range(12):
        base = rnd.choices(vocab, k=rnd.randint(30, 150))
        for c in range(rnd.choice([1, 1, 2, 3, 25])):
            copy = list(base)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(copy)))
    common = " ".join(rnd.choices(vocab, k=40))                          # a passage that otherwise unlike texts share
    rows += [(len(rows) + k, common + " " + " ".join(rnd.choices(vocab, k=40))) for k in range(60)]
    rows += [(900, None), (901, ""), (902, "two words"), (903, "two words"), (904, "two  words"), (0, rows[0][1]), (None, rows[5][1])]
    got = near_dup.classes(clashing(spark, rows)).collect()
    found = {}
    for r in got:
        found.setdefault(r.class_id, set()).add(r.doc_id)
    assert {frozenset(v) for v in found.values()} == brute_classes(rows)
    kept = [r.class_id for r in got if r.kept]
    assert sorted(map(str, kept)) == sorted(map(str, found)) and all(r.doc_id == r.class_id for r in got if r.kept)
    stage = near_dup.keep_stage(clashing(spark, rows))
    assert stage.columns == clashing(spark, rows).columns and {r.doc_id for r in stage.collect()} == set(found)
    assert near_dup.classes(clashing(spark, [])).collect() == []


def test_near_copies_within_a_large_passage_group_are_all_found(spark):
    import numpy as np

    rnd = random.Random(23)
    vocab = [f"w{k}" for k in range(2000)]
    rows = []
    for _ in range(150):                                                 # pairs of near copies; texts of different pairs share the passage only
        own = rnd.choices(vocab, k=40)
        rows += [(len(rows) + c, "spam " * 60 + " ".join([*own[:-1], own[-1] + "x" * c])) for c in range(2)]
    # One band of one sample: most texts draw the passage and fall into one group.
    doc, h, tf = near_dup.shingles([t.encode() for _, t in rows])
    df = Counter(h.tolist())
    w = near_dup.weigh(np.array([df[x] for x in h.tolist()]), tf, len(rows))
    band = [near_dup.signatures(h[doc == k], w[doc == k], 1, 1)[0] for k in range(len(rows))]
    assert Counter(band).most_common(1)[0][1] > 100
    together = [(k, k + 1) for k in range(0, len(rows), 2) if band[k] == band[k + 1]]
    of = {r.doc_id: r.class_id for r in near_dup.classes(clashing(spark, rows), bands=1, rows=1).collect()}
    assert len(together) > 50 and all(of[a] == of[b] for a, b in together)
    assert all(of[k] in (k, k - k % 2) for k in of)                      # different pairs are not similar


def test_consistent_weighted_samples_estimate_weighted_jaccard():
    import numpy as np

    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 300, dtype=np.uint64)
    w1 = rng.uniform(1, 3, 300)
    w2 = w1 * np.where(rng.random(300) < 0.3, rng.uniform(0.2, 1, 300), 1)
    a, b = (near_dup.signatures(keys, w, 600, 1) for w in (w1, w2))
    true = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    assert np.mean(np.array(a) == np.array(b)) == pytest.approx(true, abs=0.06)


ITEM = "Anna has 12 apples and gives 5 km of rope to Bob. How many apples does Anna have after 3 days when Bob gives 12 back to the old farmer?"


def test_decontamination_finds_verbatim_and_reparameterised_items(spark):
    other = ITEM.replace("Anna", "Clara").replace("Bob", "Dave").replace("12", "97").replace("5 km", "8 km").replace(" 3 ", " 14 ")
    broken = ITEM.replace("Anna has 12", "Clara has 97").replace("gives 5", "gives 8")          # Anna stands for two names, 12 for two numbers
    plain = "the quick brown fox jumps over the lazy dog while seven grey geese fly slowly to the far north"
    rows = [(1, f"Before it stood this, {ITEM} And after it that."), (2, f"words, {other} more words"), (3, f"words, {broken} more"),
            (4, plain.upper() + " indeed"), (5, "a clean text about nothing in particular that no benchmark holds at all"), (6, None), (7, ""),
            (1, f"Before it stood this, {ITEM} And after it that."), (None, plain), (8, plain[:30])]
    docs = clashing(spark, rows)
    bench = spark.createDataFrame([(10, ITEM, 1), (11, plain, 1), (12, None, 1), (13, "too short", 1), (14, "five tokens are enough here", 1)], "item_id long, text string, doc_id long")
    got = {(r.doc_id, r.item_id) for r in template_decontam.matches(docs, bench).collect()}
    assert got == {(1, 10), (2, 10), (4, 11), (None, 11)}
    clean = template_decontam.clean_stage(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 5, 6, 7, 8]
    assert template_decontam.matches(docs, bench.limit(0)).collect() == [] and template_decontam.matches(docs.limit(0), bench).collect() == []


def test_decontamination_judges_each_copy_by_itself(spark):
    other = ITEM.replace("Anna", "Clara").replace("Bob", "Dave").replace("12", "97").replace("5 km", "8 km").replace(" 3 ", " 14 ")
    broken = ITEM.replace("Anna has 12", "Clara has 97").replace("gives 5", "gives 8")
    longer = ITEM.replace("rope to", "rope and wire to")                 # words put in: two starts, one copy
    rows = [(1, f"We read. {ITEM} {other}"), (2, f"We read. {other} In between words. {ITEM} {broken}"), (3, f"We read. {broken} {broken}"),
            (4, f"We read. {longer} {'far away and more ' * 30} {other.replace('97', '41')}")]
    bench = spark.createDataFrame([(10, ITEM)], "item_id long, text string")
    assert {r.doc_id for r in template_decontam.matches(clashing(spark, rows), bench).collect()} == {1, 2, 4}


def test_short_items_that_texts_hold_by_chance_empty_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    word = docs.selectExpr("explode(split(lower(text), ' ')) w").groupBy("w").count().orderBy("count", ascending=False).first().w
    bench = spark.createDataFrame(list(enumerate(["True", "The", "2 + 2 = 4", word, f"{word} {word} {word}", "of the in", "So it goes."])), "item_id long, text string")
    assert template_decontam.clean_stage(docs, bench).count() == docs.count()
    more = docs.unionByName(docs.limit(1).selectExpr("999L doc_id", "'He said so it goes, then.' text", "lang", "source", "n_chars"))
    assert [(r.doc_id, r.item_id) for r in template_decontam.matches(more, bench).collect()] == [(999, 6)]


def test_planted_templates_with_new_values(spark):
    """Items with their numbers, names and units changed one for one are found, with one value changed in one place only they are not."""
    rnd = random.Random(8)
    vocab = [a + b + c for a in ("ba", "ko", "ti", "ru", "se", "lom") for b in ("na", "vi", "do") for c in ("sk", "l", "mp")]
    names = ["Anna", "Boris", "Clara", "Dilek", "Emil", "Fatma"]
    items, rows, want = [], [], set()
    for k in range(25):
        words = rnd.choices(vocab, k=22)
        first, second = rnd.sample(names, 2)
        for at, slot in ((4, "{a}"), (9, "{x} {u}"), (13, "{b}"), (17, "{y} {u}"), (20, "{a}")):
            words[at] = slot
        text = "we saw " + " ".join(words)
        fill = dict(a=first, b=second, x=10 + k, y=50 + k, u="km")
        items.append((k, text.format(**fill)))
        other = dict(a="Gerda", b="Hasan", x=1000 + k, y=7, u="days")
        rows.append((2 * k, "Filler words of nothing. " + text.format(**other) + " and so on it went"))
        want.add((2 * k, k))
        torn = text.replace("{a}", "Ilse", 1).format(**other)          # one of two mentions of the name differs
        rows.append((2 * k + 1, "Filler words of nothing. " + torn + " and so on it went"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in template_decontam.matches(clashing(spark, rows), bench).collect() if r.n_hits == r.n_windows} == want


def test_decontamination_finds_every_verbatim_copy(spark):
    items = ["New York City Hall Opens Its Doors Again After Long Repairs", "12 + 7 = 19 and 3 + 4 = 7", "1 2 3 4 5 6 7 8 9 10 11 12", "So it goes",
             "Tom Kim Ann Bob Eve Sue", "Carl met 3 old men"]
    before = ["", "We read ", "We read, ", "They Said ", "And then. ", "(", "The New "]
    rows = [(100 * k + j, f"{b}{t}{end}") for k, t in enumerate(items) for j, b in enumerate(before) for end in [" and more words here."]]
    rows += [(100 * k + 50, f"we read {t.lower()} again") for k, t in enumerate(items)] + [(900, "1 3 5 7 9 11 13 15 17 19 21 23 25"), (901, "so he goes and Ann met Tom"), (902, "We read Eva met 8 old men")]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(100 * k + j, k) for k in range(len(items)) for j in [*range(len(before)), 50]} | {(902, 5)}
    assert {(r.doc_id, r.item_id) for r in template_decontam.matches(clashing(spark, rows), bench).collect()} == want


def test_decontamination_against_verbatim_search(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in template_decontam.matches(docs, bench).collect()}
    items = bench.collect()
    assert got == {(d.doc_id, b.item_id) for d in docs.collect() for b in items if b.text in d.text}


def test_importance_prefers_target_text(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.withColumnsRenamed({"lang": "kept", "source": "key"})
    got = importance.resample(docs, labels)
    rows = got.join(labels, "doc_id").groupBy("quality", "toxic").agg({"kept": "count", "doc_id": "count"})
    share = {(r.quality, r.toxic): r for r in got.join(labels, "doc_id").selectExpr("quality", "toxic", "int(kept) as k").groupBy("quality", "toxic").avg("k").collect()}
    assert rows.count() == len(share)
    assert share[1, 0]["avg(k)"] > 0.95 and share[0, 0]["avg(k)"] < 0.1
    assert got.where("kept").count() == round(0.8 * docs.count())


def test_importance_weight_against_direct_counts(spark):
    rows = [(k, " ".join(["good", "fine", f"w{k % 7}"] * (1 + k % 3)) if k % 2 else " ".join(["bad", "awful", f"w{k % 5}"] * 2)) for k in range(40)]
    rows += [(100, None), (101, ""), (None, "good")]
    labels = spark.createDataFrame([(k, 1 if k % 2 else 0, 0) for k in range(30)] + [(1, None, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.log_weight for r in importance.weights(clashing(spark, rows), labels).collect()}
    target = {k for k in range(30) if k % 2 and k not in (1, 3)}
    import math

    grams = lambda t: [Counter((t or "").split()), Counter(zip((t or "").split(), (t or "").split()[1:]))]
    raw = [sum((grams(t)[o] for _, t in rows), Counter()) for o in (0, 1)]
    good = [sum((grams(t)[o] for k, t in rows if k in target), Counter()) for o in (0, 1)]
    part = sum(good[0].values()) / sum(raw[0].values())
    for k, t in rows:
        want = sum(n * math.log((good[o][g] - n * (k in target) + m) / ((raw[o][g] - n) * part + m)) for o, m in enumerate(importance.PSEUDO) for g, n in grams(t)[o].items())
        assert got[k] == pytest.approx(want, abs=1e-6)
    assert importance.resample(clashing(spark, []), labels).collect() == []
    assert {r.log_weight for r in importance.weights(clashing(spark, rows), labels.limit(0)).collect()} == {0.0}


@pytest.mark.parametrize("values", [[3.0], [1.0, 1.0, 2.0], [float(k % 10) for k in range(50)], [0.1 * k for k in range(3000)], [1e-9, 1e9, -1e9, 5.0]])
def test_threshold_is_the_kth_greatest(spark, values):
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    for k in {1, len(values), max(1, len(values) // 3)}:
        assert importance.threshold(keys, k) == sorted(values, reverse=True)[k - 1]
    assert importance.threshold(keys, 0) is None


def test_long_texts_are_cut_into_slices_of_rows():
    import pyarrow as pa

    from postwave.llm.common import slices

    texts = ["a" * (SLICE_BYTES // 3)] * 7 + [None, "", "b" * (2 * SLICE_BYTES)]
    parts = list(slices(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])]), "t"))
    assert sum((p.column(0).to_pylist() for p in parts), []) == texts and len(parts) >= 4
