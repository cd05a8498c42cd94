"""The whole corpus pipeline against its stages by brute force, and its defined cases."""

import hashlib
import random
import re

import sentencepiece

import corpus_pipeline
from postwave.llm import quality_rules
from tests.llm.test_document_operators import MODEL, SF, brute_classes, direct_line_dedup, lines_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rnd, n):
    return " ".join(rnd.choice(["harbor", "window", "quiet", "marble", "seven", "under", "yellow", "copper", "listen", "garden", "winter", "paper", "river", "copy"])
                    + rnd.choice("abcdefghijklmnop") for _ in range(n))


def corpus(spark):
    rnd = random.Random(17)
    docs = [re.sub(r"\n\s*\n+", "\n", r.text or "").strip("\n") for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()][:60]
    docs += ["\n".join(sentence(rnd, 12) for _ in range(6)) for _ in range(12)]
    passage = [sentence(rnd, 14) for _ in range(4)]
    docs += ["\n".join([sentence(rnd, 15), *passage, sentence(rnd, 15)]) for _ in range(5)]
    near = [sentence(rnd, 80).split(" ") for _ in range(3)]
    docs += [" ".join(w + ("z" if k and i == 40 else "") for i, w in enumerate(n)) for n in near for k in range(3)]
    item = "which of these nine harbors lies farthest from the mountain where the river begins"
    docs += [f"{sentence(rnd, 30)}. We ask {item} and wait. {sentence(rnd, 30)}", "", "too short", "spam " * 400]
    rows = [(i, t) for i, t in enumerate(docs)] + [(900, None), (901, docs[61])]
    return rows, item


def test_pipeline_against_brute_force(spark, tmp_dir):
    rows, item = corpus(spark)
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, item), (2, "The")], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, tmp_dir).collect()}
    kept = {r.doc_id for r in quality_rules.judge(spark.read.parquet(f"{tmp_dir}/documents.parquet")).where("kept").collect()}
    assert 60 < len(kept) < len(rows)
    now = [(i, t) for i, t in rows if i in kept]
    done = direct_line_dedup(now)
    now = [(i, "\n".join(done[i, t])) for i, t in now]
    assert all(lines_of(t) == t.split("\n") or not t for _, t in now)
    first = {min(c) for c in brute_classes(now)}
    now = [(i, t) for i, t in now if i in first and item not in (t or "").lower()]
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {}
    for i, t in now:
        ids = [*sp.encode(t), sp.eos_id()]
        want[i] = (len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids)))
    assert got == want


def test_stages_return_documents_and_empty_tables_stay_empty(spark, tmp_dir):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tmp_dir)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0
