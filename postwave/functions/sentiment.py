"""Text sentiment as column expressions.

The reference ran a neural German model per post. Here the same outputs (sentence classes 0..4,
a length-weighted mean, a plain mean, the class of the longest sentence, -1 when there is no
sentence) come from a word lexicon, evaluated with higher-order functions on the row itself:
no UDF, no explode, no shuffle. The whole text is always scored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of this library (not taken from anywhere): sentence and token patterns, and the
# lexicon. A sentence is a run of characters other than . ! ? and line breaks, with its closing
# punctuation, trimmed of spaces; a token is a run of letters, compared in lower case.
SENTENCE_PATTERN = "[^.!?\\r\\n]+[.!?]*"
TOKEN_PATTERN = "\\p{L}+"

POSITIVE_WORDS = (
    "gut", "super", "toll", "schön", "danke", "freude", "liebe", "stark", "erfolg", "hoffnung",
    "good", "great", "love", "happy", "excellent", "best", "win", "nice", "thanks", "hope",
    "bien", "bon", "bonne", "merci", "joie", "bueno", "buena", "gracias", "feliz", "excelente",
)
NEGATIVE_WORDS = (
    "schlecht", "nein", "leider", "angst", "fehler", "krise", "falsch", "wut", "problem", "schade",
    "bad", "worst", "hate", "sad", "wrong", "fail", "poor", "angry", "terrible", "crisis",
    "mal", "mauvais", "triste", "peur", "malo", "mala", "miedo", "error", "odio", "nunca",
)

NO_SENTENCE = -1.0


def sentences(text: Column) -> Column:
    """Array of the sentences of ``text`` in order."""
    parts = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SENTENCE_PATTERN), F.lit(0))
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != F.lit(""))


def sentence_class(sentence: Column, positive=POSITIVE_WORDS, negative=NEGATIVE_WORDS) -> Column:
    """Class 0..4 of one sentence: net = positive - negative tokens, clamped to [-2, 2], plus 2.

    Tokens are extracted once; a hash-set filter keeps only lexicon words, and the fold runs over
    those few hits; the net score is used once (no CASE that would repeat it).
    """
    tokens = F.regexp_extract_all(F.lower(sentence), F.lit(TOKEN_PATTERN), F.lit(0))
    hits = F.filter(tokens, lambda t: t.isin(*positive, *negative))
    net = F.aggregate(hits, F.lit(0), lambda acc, t: acc + F.when(t.isin(*positive), 1).otherwise(-1))
    return (F.least(F.greatest(net, F.lit(-2)), F.lit(2)) + 2).cast("int")


def scored_sentences(text: Column, positive=POSITIVE_WORDS, negative=NEGATIVE_WORDS, classify=None) -> Column:
    """array<struct<pos:int, len:int, cls:int>>, one element per sentence. ``classify`` (sentence -> class, such as
    ``sentence_model.SentenceModel.classify``) takes the place of the word lists."""
    classify = classify or (lambda s: sentence_class(s, positive, negative))
    return F.transform(sentences(text), lambda s, i: F.struct((i + 1).alias("pos"), F.char_length(s).alias("len"), classify(s).alias("cls")))


def sentiment_parts(text: Column, positive=POSITIVE_WORDS, negative=NEGATIVE_WORDS, classify=None) -> Column:
    """One fold over the sentences: struct<n, wsum, lsum, csum, main_len, main_cls>.

    Stage it as a column (``select``) and derive the means from that column: every mean reads the
    parts several times, and an un-staged fold would be re-run for each read.
    """
    classify = classify or (lambda s: sentence_class(s, positive, negative))
    scored = F.transform(sentences(text), lambda s: F.struct(F.char_length(s).alias("len"), classify(s).alias("cls")))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("wsum"), F.lit(0).cast("bigint").alias("lsum"),
                    F.lit(0).cast("bigint").alias("csum"), F.lit(0).alias("main_len"), F.lit(-1).alias("main_cls"))

    def step(acc, x):
        longer = x["len"] > acc["main_len"]
        return F.struct((acc["n"] + 1).alias("n"),
                        (acc["wsum"] + (x["cls"] * x["len"]).cast("bigint")).alias("wsum"),
                        (acc["lsum"] + x["len"].cast("bigint")).alias("lsum"),
                        (acc["csum"] + x["cls"].cast("bigint")).alias("csum"),
                        F.when(longer, x["len"]).otherwise(acc["main_len"]).alias("main_len"),
                        F.when(longer, x["cls"]).otherwise(acc["main_cls"]).alias("main_cls"))
    return F.aggregate(scored, zero, step)


def weighted_from_parts(parts: Column) -> Column:
    """sum(class * length) / sum(length); -1 with no sentence. Integer sums, one division."""
    return F.when(parts["n"] == 0, F.lit(NO_SENTENCE)).otherwise(parts["wsum"] / parts["lsum"])


def mean_from_parts(parts: Column) -> Column:
    """Plain mean of the classes; -1 with no sentence."""
    return F.when(parts["n"] == 0, F.lit(NO_SENTENCE)).otherwise(parts["csum"] / parts["n"])


def main_from_parts(parts: Column) -> Column:
    """Class of the longest sentence, the first one on ties; -1 with no sentence."""
    return parts["main_cls"].cast("int")


def with_sentiment(df: DataFrame, text_col: str = "text", weighted: str | None = "sentiment",
                   mean: str | None = None, main: str | None = None,
                   positive=POSITIVE_WORDS, negative=NEGATIVE_WORDS, classify=None) -> DataFrame:
    """Adds the chosen sentiment columns; the text is scored once. Word lists (lower case) may be
    replaced; they travel inside the plan as hash sets, so their size is the caller's bound. Any other
    scorer's output can equally replace the ``sentiment`` column of the posts before the metrics."""
    staged = df.withColumn("_sp", sentiment_parts(F.col(text_col), positive, negative, classify))
    outs = []
    if weighted:
        outs.append(weighted_from_parts(F.col("_sp")).alias(weighted))
    if mean:
        outs.append(mean_from_parts(F.col("_sp")).alias(mean))
    if main:
        outs.append(main_from_parts(F.col("_sp")).alias(main))
    return staged.select(*[c for c in df.columns], *outs)


def sentiment_label(score: Column) -> Column:
    """Label of a score on the 0..4 scale (<=0 and >=5 are not understood). Pass a column, not
    an expression: the score is read up to six times."""
    return (F.when(score <= 0, "not_understood").when(score < 1, "very_negative")
            .when(score < 2, "negative").when(score < 3, "neutral").when(score < 4, "positive")
            .when(score < 5, "very_positive").otherwise("not_understood"))
