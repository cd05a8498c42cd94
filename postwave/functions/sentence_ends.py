"""Sentence ends with learned abbreviations.

``sentiment.sentences`` ends a sentence at every ``.``, also in ``3.5``, ``Dr.`` and ``z.B.``. Here a sentence ends only at the end of a token (a run without blanks), and not where
the token is an abbreviation. Which tokens are is learned without labels from how often a word stands with and without a period: the log-likelihood
ratio of "always with" (p = 0.99) against "by chance" (p = the share of all tokens that end in a period), times a weight for short words, one for
periods inside, and a penalty for each time the word stands without.

``fit`` is one aggregate over all tokens (partial sums per task); the model is its ``MOST`` best words at most, a literal of the plan. ``split`` is an
expression over the text, linear in its length: no UDF, no join, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is an abbreviation from this score on, if it was met so often; a model has this many words at most.
LEAST_SCORE, LEAST_COUNT, MOST = 0.3, 5, 2000
#: Probability of the period after an abbreviation.
ALWAYS = 0.99
#: What may stand before a word, what may stand after an end; an end.
OPENING, END = "^[(\\[\"'«„]+", "[.!?][\"')\\]»“]*$"
MARK = "\x02"


def tokens(text: Column) -> Column:
    """Runs without blanks; line breaks are a token of their own (``MARK``), as they end a sentence."""
    return F.filter(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), f"[\r\n{MARK}]+", f" {MARK} "), " "), lambda t: t != "")


def word(token: Column) -> Column:
    """A token's word: lower case, without what opens it and without one period at its end."""
    return F.lower(F.regexp_replace(F.regexp_replace(token, OPENING, ""), "\\.$", ""))


def counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """word, n_with, n_without: how often it stands with and without a period at its end."""
    rows = texts.select(F.explode(tokens(F.col(text_col))).alias("t")).where(F.col("t") != MARK).select(word(F.col("t")).alias("word"), F.col("t").endswith(".").alias("ends"))
    return rows.where("word <> ''").groupBy("word").agg(F.count_if("ends").alias("n_with"), F.count_if(~F.col("ends")).alias("n_without"))


def scores(counted: DataFrame) -> DataFrame:
    """word, score of the words that ever stand with a period and hold a letter."""
    total = counted.agg(F.sum("n_with"), F.sum(F.col("n_with") + F.col("n_without"))).first()
    p = float(total[0] or 0) / float(total[1] or 1)
    if not 0 < p < 1:
        return counted.select("word", F.lit(0.0).alias("score")).limit(0)
    letters = F.length(F.regexp_replace("word", "[^\\p{L}]", ""))
    ratio = 2 * (F.col("n_with") * F.log(F.lit(ALWAYS / p)) + F.col("n_without") * F.log(F.lit((1 - ALWAYS) / (1 - p))))
    periods = F.length("word") - F.length(F.replace("word", F.lit("."))) + 1
    score = ratio * F.exp(-letters) * periods * F.pow(letters.cast("double"), -F.col("n_without").cast("double"))
    return counted.where((F.col("n_with") > 0) & (F.col("n_with") + F.col("n_without") >= LEAST_COUNT) & F.col("word").rlike("\\p{L}")).select("word", score.alias("score"))


def fit(texts: DataFrame, text_col: str = "text", most: int = MOST) -> list[str]:
    """The abbreviations of a corpus, without their last period: those of the best scores, ``most`` at most."""
    from postwave.session import checkpoint_root

    checkpoint_root(texts.sparkSession)
    counted = counts(texts, text_col).checkpoint()          # one row per word; read for the totals and for the scores
    best = scores(counted).where(F.col("score") >= LEAST_SCORE).orderBy(F.col("score").desc(), "word").limit(most)
    return sorted(r["word"] for r in best.collect())


def split(text: Column, abbreviations: list[str]) -> Column:
    """Array of the sentences of ``text`` in order, trimmed, none empty."""
    def marked(t: Column) -> Column:
        ends = t.rlike(END)
        if abbreviations:
            ends = ends & ~(t.endswith(".") & word(t).isin(*abbreviations))
        return F.when(ends, F.concat(t, F.lit(MARK))).otherwise(t)

    parts = F.split(F.array_join(F.transform(tokens(text), marked), " "), MARK)
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != F.lit(""))
