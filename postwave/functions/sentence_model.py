"""A trained sentence class (N2): multinomial naive Bayes over hashed words and word pairs.

``fit`` counts features per class over sentences of a bounded sample of labelled texts, with Spark aggregates; the model is one row: whole
numbers for each bucket and class, so a score is an exact sum. ``classify`` puts the model into the plan as a literal and scores a sentence with
higher-order functions, inside the JVM, without a join or a UDF. The word lists of ``functions.sentiment`` stay as the choice that
needs no labels.

The sample is bounded because the model's labels are (``sample_texts`` texts, least digests of their ids first, so that the choice doesn't depend on the
order of rows); the model has ``BUCKETS`` x 5 numbers whatever it saw.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwave.functions.sentiment import TOKEN_PATTERN, sentences

#: Three hexadecimal digits of a feature's MD5 name its bucket.
HEX_DIGITS = 3
BUCKETS = 16 ** HEX_DIGITS
CLASSES = 5
#: Log probabilities are rounded to 1 / SCALE.
SCALE = 65536
SAMPLE_TEXTS = 2000


def features(sentence: Column) -> Column:
    """Buckets (0-based) of the words and the pairs of neighbouring words of a sentence, in order."""
    words = F.regexp_extract_all(F.lower(sentence), F.lit(TOKEN_PATTERN), F.lit(0))
    # Wrapped once: the list is read by the words and twice by the pairs.
    both = F.transform(F.array(words), lambda w: F.concat(w, F.zip_with(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))))[0]
    return F.transform(both, lambda f: F.conv(F.substring(F.md5(f.cast("binary")), 1, HEX_DIGITS), 16, 10).cast("int"))


@dataclass(frozen=True)
class SentenceModel:
    """``weights``: JSON, one list of the classes' numbers per bucket; ``prior``: JSON, the classes' numbers."""

    weights: str
    prior: str

    def scores(self, sentence: Column) -> Column:
        """array<bigint> of the five classes' scores: SCALE x log probability, up to a constant."""
        table = F.from_json(F.lit(self.weights), "array<array<bigint>>")
        start = F.from_json(F.lit(self.prior), "array<bigint>")
        return F.aggregate(features(sentence), start, lambda acc, b: F.zip_with(acc, F.get(table, b), lambda x, y: x + y))

    def classify(self, sentence: Column) -> Column:
        """The class 0..4 with the greatest score, the least one on ties."""
        return F.transform(F.array(self.scores(sentence)), lambda s: F.array_position(s, F.array_max(s)) - 1)[0].cast("int")


def labelled_sentences(texts: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_col: str = "cls",
                       sample_texts: int = SAMPLE_TEXTS) -> DataFrame:
    """(cls, sentence) of the sample: each sentence has its text's class."""
    joined = texts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(labels.select(F.col(id_col).alias("_id"), F.col(class_col).alias("cls")), "_id")
    sample = joined.where("_text is not null").orderBy(F.md5(F.col("_id").cast("string").cast("binary")), "_id").limit(sample_texts)
    return sample.select("cls", F.explode(sentences(F.col("_text"))).alias("sentence"))


def fit(sample: DataFrame) -> SentenceModel:
    """The model of (cls 0..4, sentence) rows, with add-one smoothing; a class without rows keeps a small prior."""
    rows = sample.where("cls between 0 and 4")
    counted = rows.select("cls", F.explode(features(F.col("sentence"))).alias("bucket")).groupBy("cls", "bucket").agg(F.count(F.lit(1)).alias("n"))
    spark = sample.sparkSession
    # All numbers come out of Spark as one row: 5 x BUCKETS whole numbers.
    grid = spark.range(CLASSES * BUCKETS).select(F.expr(f"cast(id div {BUCKETS} as int)").alias("cls"), (F.col("id") % BUCKETS).cast("int").alias("bucket"))
    totals = counted.groupBy("cls").agg(F.sum("n").alias("total"))
    per = grid.join(counted, ["cls", "bucket"], "left").join(totals, "cls", "left")
    per = per.select("cls", "bucket", F.round(SCALE * (F.log(F.coalesce("n", F.lit(0)) + 1.0) - F.log(F.coalesce("total", F.lit(0)) + float(BUCKETS)))).cast("long").alias("w"))
    per = per.groupBy("bucket").agg(F.transform(F.sort_array(F.collect_list(F.struct("cls", "w"))), lambda x: x["w"]).alias("w"))
    weights = per.agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "w"))), lambda x: x["w"])).alias("j")).first()[0]
    n = {r["cls"]: r["n"] for r in rows.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect()}
    every = sum(n.values()) + float(CLASSES)
    start = json.dumps([round(SCALE * (math.log(n.get(c, 0) + 1.0) - math.log(every))) for c in range(CLASSES)])
    return SentenceModel(weights, start)

