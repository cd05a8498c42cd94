from pyspark.sql import functions as F

from postwave.functions import sentiment as S


def score(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    out = S.with_sentiment(df, "text", "w", "m", "main").withColumn("n", F.size(S.sentences(F.col("text"))))
    out = out.withColumn("label", S.sentiment_label(F.col("w")))
    return [r.asDict() for r in out.orderBy("i").collect()]


def test_no_sentence_gives_minus_one(spark):
    r = score(spark, ["", "   ", "...", None])
    assert [x["w"] for x in r] == [-1.0, -1.0, -1.0, -1.0]
    assert [x["main"] for x in r] == [-1, -1, -1, -1]
    assert r[0]["label"] == "not_understood"


def test_classes_and_weighting(spark):
    # "Gut." -> +1 -> class 3, len 4; "Schlecht und falsch!" -> -2 -> class 0, len 20
    r = score(spark, ["Gut. Schlecht und falsch!"])[0]
    assert r["n"] == 2
    assert r["w"] == (3 * 4 + 0 * 20) / 24
    assert r["m"] == 1.5
    assert r["main"] == 0            # longest sentence


def test_one_sentence_and_ties(spark):
    r = score(spark, ["Das ist gut", "Gut gut. Bad bad."])
    assert r[0]["n"] == 1 and r[0]["w"] == 3.0 and r[0]["label"] == "positive"
    assert r[1]["main"] == 4          # equal lengths: the first sentence wins
    assert r[1]["w"] == 2.0


def test_newline_splits_sentences(spark):
    r = score(spark, ["eins\nzwei drei"])[0]
    assert r["n"] == 2


def test_whole_text_is_scored(spark):
    long_text = "Neutral words here. " * 5000 + "Good good good."
    r = score(spark, [long_text])[0]
    assert r["n"] == 5001
    assert r["w"] > 2.0


def test_custom_word_lists(spark):
    df = spark.createDataFrame([(0, "Sonnig heute. Regen morgen!")], "i int, text string")
    r = S.with_sentiment(df, "text", "w", positive=("sonnig",), negative=("regen",)).collect()[0]
    # "Sonnig heute." -> +1 -> class 3 (len 13); "Regen morgen!" -> -1 -> class 1 (len 13)
    assert r["w"] == (3 * 13 + 1 * 13) / 26


def test_trained_classes_against_counting(spark):
    """Naive Bayes by hand over a small sample; held-out sentences get their classes."""
    import hashlib
    import math
    import re

    from postwave.functions import sentence_model as SM

    good, bad = ["schöner Tag heute", "sehr schöner Abend", "heute schöner Abend!"], ["übler Regen", "sehr übler Tag", "übler Regen heute?"]
    texts = spark.createDataFrame([(i, ". ".join(s)) for i, s in enumerate([good, bad, [], ["neutral hier"]])], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 4), (1, 0), (3, 2), (9, 1)], "doc_id long, cls int")
    model = SM.fit(SM.labelled_sentences(texts, labels))

    def buckets(s):
        w = re.findall(r"[^\W\d_]+", s.lower())
        return [int(hashlib.md5(f.encode()).hexdigest()[:SM.HEX_DIGITS], 16) for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    sample = [(4, s) for s in good] + [(0, s) for s in bad] + [(2, "neutral hier")]
    n = {c: [b for k, s in sample if k == c for b in buckets(s)] for c in range(5)}

    def scores(s):
        out = []
        for c in range(5):
            prior = math.log(sum(k == c for k, _ in sample) + 1.0) - math.log(len(sample) + 5.0)
            out.append(round(SM.SCALE * prior) + sum(round(SM.SCALE * (math.log(n[c].count(b) + 1.0) - math.log(len(n[c]) + SM.BUCKETS))) for b in buckets(s)))
        return out

    asked = ["ein schöner Abend", "Regen, übler Regen", "", "123", "neutral"]
    got = spark.createDataFrame([(s,) for s in asked], "s string").select("s", model.scores(F.col("s")).alias("x"), model.classify(F.col("s")).alias("c")).collect()
    assert [r["x"] for r in got] == [scores(s) for s in asked]
    assert [r["c"] for r in got] == [max(range(5), key=lambda c: (x[c], -c)) for x in map(scores, asked)] and [r["c"] for r in got][:2] == [4, 0]
    parts = S.with_sentiment(spark.createDataFrame([("ein schöner Abend. Regen, übler Regen.",)], "text string"), mean="m", classify=model.classify).first()
    assert parts["m"] == 2.0
    plan = spark.createDataFrame([("x",)], "s string").select(model.classify(F.col("s")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan


def test_sentence_ends_learn_abbreviations(spark):
    from postwave.functions import sentence_ends as SE

    texts = [f"Herr Dr. Weber kam z.B. am Tag {k}. Er sah ca. 3.5 km weit! War das gut? Ja sagte er, ja." for k in range(30)] + [None, "", "  \n ", "Der Tag war lang. Und der Weg war weit."]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    learned = SE.fit(df)
    assert {"dr", "z.b", "ca"} <= set(learned) and not {"tag", "ja", "lang", "weit"} & set(learned)
    assert SE.fit(df, most=1) != learned and len(SE.fit(df, most=1)) == 1 and SE.fit(df.limit(0)) == []
    asked = ["Herr Dr. Weber kam z.B. am Montag. Er sah (ca. 3.5 km) weit!\nWar das gut? Ja", "x", None, "\n\n", 'Er rief "Halt!" Dann "Dr. Weber."']
    got = spark.createDataFrame([(t,) for t in asked], "text string").select(SE.split(F.col("text"), learned).alias("s"))
    assert [r["s"] for r in got.collect()] == [["Herr Dr. Weber kam z.B. am Montag.", "Er sah (ca. 3.5 km) weit!", "War das gut?", "Ja"], ["x"], [], [],
                                               ['Er rief "Halt!"', 'Dann "Dr. Weber."']]
    plan = df.select(SE.split(F.col("text"), learned))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
