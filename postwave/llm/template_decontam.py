"""Benchmark decontamination by templates, with DataFrame functions only.

Texts are canonicalised: numbers, names (words inside a sentence with one capital, then small letters) and units after numbers
become typed placeholders, the rest lower-case words without punctuation. Windows of ``window``
tokens of benchmark items are hash-joined with those of all documents. A document holds an item if it
has at least ``min_share`` of the item's windows in an occurrence whose slot values are consistent: over its matched
windows each value of the item stands for one value of the document and each of these for one of the
item, so that a re-parameterised question counts and unlike texts of the same template don't. Occurrences are
the hits of one aligned start, those of a run of neighbouring starts (a copy with words put in or left out) and those
of the whole document; one consistent occurrence is enough, whatever else the document holds.

Besides, each window of an item, also one of mostly placeholders and those of items of fewer than ``min_tokens``, joins
by its literal lower-case words; a start at which all windows of the item stand in these words is a copy, whatever is
marked in it. A short item (fewer than ``min_tokens``) that texts may hold by chance identifies nothing: it counts from ``SHORT_WORDS`` words, ``SHORT_CHARS`` letters and digits and
``SHORT_BITS`` on, the sum of log2(documents / documents with the word) over its words. An item without a window by template needs ``min_share`` of them. The first word of an item is taken as a name and as a plain word, as what stands before it decides.

Cost: one pass over the documents; only rows of matched windows leave it. Each token is hashed once; windows of 2, 4 and 8 tokens come from hashes of half their
width, and those of all other widths from these, so one pass serves all widths. Literal windows are made for texts with placeholders only. The benchmark side joins as
Spark sees fit (broadcast under its size threshold, else shuffled by window hash); window hashes are
spread evenly, and a window that a third of all documents hold only multiplies rows by the items that
hold it too. Windows of mostly placeholders identify nothing by their template and only join literally. Slot values are only
read again for documents that matched a window with slots.

Defined cases: null and empty texts hold nothing; an item of fewer tokens than ``window`` is one window
of its own length, and one of fewer than ``min_tokens`` is only matched literally, if at all; one without a word never; an item found twice in a document
is one pair; rows that repeat a document's id and text are one document; null item ids are kept as null; an empty
benchmark or documents table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postwave.llm.common import stored

#: Units that may follow a number.
UNITS = ("km|m|cm|mm|kg|g|mg|l|ml|miles?|feet|foot|inch|inches|pounds?|ounces?|dollars?|euros?|cents?|usd|eur|percent|"
         "seconds?|minutes?|hours?|days?|weeks?|months?|years?|meters?|metres?|kilometers?|grams?|kilograms?|liters?|litres?|"
         "pfund|euro|prozent|gramm|kilogramm|sekunden?|minuten?|stunden?|tagen?|tag|wochen?|monaten?|monat|jahren?|jahr|"
         "kilomètres?|mètres?|grammes?|heures?|jours?|semaines?|mois|ans?|années?|"
         "kilómetros?|metros?|gramos?|litros?|segundos?|minutos?|horas?|días?|semanas?|mes|meses|años?")
#: What an item of fewer tokens than ``min_tokens`` must have to count.
SHORT_WORDS, SHORT_CHARS, SHORT_BITS = 3, 8, 6.0
NUMBER, UNIT, NAME, POINT = "\x01", "\x02", "\x03", "\x04"


def valued(text: Column) -> Column:
    """The text's tokens, joined by blanks; a token with a slot is its mark, then its value."""
    t = F.translate(F.coalesce(text, F.lit("")), NUMBER + UNIT + NAME + POINT, "    ")
    has_number = t.rlike("\\p{N}")
    t = F.when(has_number, F.regexp_replace(t, "(\\p{N})[.,](\\p{N})", f"$1{POINT}$2")).otherwise(t)
    t = F.regexp_replace(t, "(?<=[\\p{L}\\p{N},;] )(\\p{Lu}[\\p{Ll}\\p{M}]+)", f"{NAME}$1")
    with_number = F.regexp_replace(F.concat(F.lower(F.regexp_replace(t, f"[\\p{{N}}{POINT}]+", f" {NUMBER}$0 ")), F.lit(" ")),
                                   f"({NUMBER}[\\p{{N}}{POINT}]+) +({UNITS})([^\\p{{L}}\\p{{M}}])", f"$1 {UNIT}$2$3")
    t = F.when(has_number, with_number).otherwise(F.lower(t))
    return F.trim(F.regexp_replace(t, "[^\\p{L}\\p{M}\\p{N}\x01-\x04]+", " "))


def canonical(valued_text: Column) -> Column:
    return F.regexp_replace(valued_text, "([\x01-\x03])[^ ]+", "$1")


def literal(valued_text: Column) -> Column:
    """The same tokens without marks."""
    return F.translate(valued_text, NUMBER + UNIT + NAME, "")


def _words(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def _joined(a: Column, b: Column, shift: int, n: Column) -> Column:
    """The hash of a's entry and of b's entry ``shift`` places on, for the first n places."""
    return F.zip_with(F.slice(a, 1, n), F.slice(b, shift + 1, n), lambda x, y: F.xxhash64(x, y))


def with_windows(df: DataFrame, tokens: str, widths: list[int], prefix: str) -> DataFrame:
    """Adds ``<prefix><w>`` for each width: the hash of each window of w tokens, in order; none if there are fewer tokens.

    Every array is a column of its own, so it is made once, whatever is built on it."""
    size = lambda w: F.greatest(F.size(tokens) - (w - 1), F.lit(0))
    top = max(widths, default=1).bit_length() - 1
    df = df.withColumn(f"{prefix}_1", F.transform(tokens, lambda t: F.xxhash64(t)))
    for k in range(top):
        w = 1 << k
        df = df.withColumn(f"{prefix}_{2 * w}", _joined(F.col(f"{prefix}_{w}"), F.col(f"{prefix}_{w}"), w, size(2 * w)))
    for w in widths:
        bits = [1 << k for k in range(top, -1, -1) if w >> k & 1]
        got, done = F.col(f"{prefix}_{bits[0]}"), bits[0]
        for more in bits[1:]:
            got = _joined(got, F.col(f"{prefix}_{more}"), done, size(done + more))
            done += more
        df = df.withColumn(f"{prefix}{w}", got)
    return df.drop(*[f"{prefix}_{1 << k}" for k in range(top + 1)])


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int, min_tokens: int) -> DataFrame:
    """item_id, item (hash of id and text), width, kind, q, h, n_tokens, words (values), n_windows, exact (all windows count only), slots (offset, mark, value) of each window.

    kind: 0 template, 1 template of the first window with the item's first word as a name, 2 literal."""
    t = F.col(f"`{text_col}`").cast("string")
    items = (benchmark.select(F.col(f"`{id_col}`").alias("item_id"), valued(t).alias("valued"),
                              F.coalesce(t, F.lit("")).rlike("^[^\\p{L}\\p{M}\\p{N}]*\\p{Lu}[\\p{Ll}\\p{M}]+").alias("may_be_name")).distinct()
             .withColumn("item", F.xxhash64("item_id", "valued", "may_be_name"))
             .withColumn("values", _words(F.col("valued"))).withColumn("tokens", _words(canonical(F.col("valued"))))
             .withColumn("words", _words(literal(F.col("valued"))))
             .where(F.size("tokens") > 0).withColumn("width", F.least(F.size("tokens"), F.lit(window))))
    first = F.get("values", F.lit(0))
    named = (items.where(F.col("may_be_name") & ~first.rlike("^[\x01-\x03]")).withColumn("kind", F.lit(1))
             .withColumn("values", F.concat(F.array(F.concat(F.lit(NAME), first)), F.expr("slice(values, 2, size(values))")))
             .withColumn("tokens", F.concat(F.array(F.lit(NAME)), F.expr("slice(tokens, 2, width - 1)"))))
    rows = (items.withColumn("kind", F.lit(0)).unionByName(named).where(F.size("values") >= min_tokens)
            .unionByName(items.withColumn("kind", F.lit(2)).withColumn("tokens", F.col("words")).withColumn("values", F.col("words"))))
    widths = list(range(1, window + 1))
    rows = with_windows(rows, "tokens", widths, "w")
    hashes = F.coalesce(*[F.when(F.col("width") == w, F.col(f"w{w}")) for w in widths])
    rows = rows.select("item_id", "item", "kind", "width", "values", F.posexplode(hashes).alias("q", "h"))
    slot = F.filter(F.transform(F.sequence(F.lit(0), F.col("width") - 1),
                                lambda k: F.struct(k.alias("k"), F.get("values", F.col("q") + k).alias("value"))),
                    lambda s: s["value"].rlike("^[\x01-\x03]"))
    rows = rows.withColumn("slots", slot).where(F.size("slots") * 2 <= F.col("width"))
    n = (rows.groupBy("item").agg(F.count_distinct(F.when(F.col("kind") < 2, F.col("q"))).alias("n_coded"),
                                  F.count_distinct(F.when(F.col("kind") == 2, F.col("q"))).alias("n_words")).withColumnRenamed("item", "of_item"))
    return (rows.join(n, F.col("item") == F.col("of_item"))
            .select("item_id", "item", "kind", "width", "q", "h", F.size("values").alias("n_tokens"), F.col("values").alias("words"), F.when(F.col("kind") == 2, F.col("n_words")).otherwise(F.col("n_coded")).alias("n_windows"),
                    ((F.col("kind") == 2) & (F.col("n_coded") > 0)).alias("exact"), "slots"))


def chance_items(items: DataFrame, base: DataFrame, min_tokens: int) -> DataFrame:
    """item: the short items that texts may hold by chance."""
    short = items.where((F.col("kind") == 2) & (F.col("n_tokens") < min_tokens)).select("item", "n_tokens", "words").dropDuplicates(["item"])
    if short.isEmpty():
        return short.select("item")
    asked = short.select("item", "n_tokens", "words", F.explode(F.array_distinct("words")).alias("word"))
    seen = base.select(F.explode(F.array_distinct(_words(literal(valued(F.col("text")))))).alias("word"))
    df = seen.join(asked.select("word").distinct(), "word").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    n = base.count()
    bits = F.log2(F.lit(n + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0))
    judged = asked.join(df, "word", "left").groupBy("item", "n_tokens", "words").agg(F.sum(bits).alias("bits"))
    chars = F.length(F.regexp_replace(F.array_join("words", ""), "[^\\p{L}\\p{N}]", ""))
    return judged.where((F.col("n_tokens") < SHORT_WORDS) | (chars < SHORT_CHARS) | (F.col("bits") < SHORT_BITS)).select("item")


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
            item_text: str = "text", window: int = 8, min_tokens: int = 5, min_share: float = 0.5) -> DataFrame:
    """doc_id, text_hash, item_id, n_hits, n_windows of each document and item that it holds."""
    text = F.col(f"`{text_col}`").cast("string")
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    every = stored(item_windows(benchmark, item_id, item_text, window, min_tokens), "decontam-items")
    items = every.join(stored(chance_items(every, base, min_tokens), "decontam-chance"), "item", "left_anti").drop("words", "n_tokens")
    widths = sorted({r.width for r in items.select("width").distinct().collect()}) or [window]     # at most window values
    coded = base.select("doc_id", F.xxhash64("text").alias("text_hash"), valued(F.col("text")).alias("valued"))
    slotted = F.col("valued").rlike("[\x01-\x03]")
    coded = coded.select("doc_id", "text_hash", _words(canonical(F.col("valued"))).alias("tokens"),
                         F.when(slotted, _words(literal(F.col("valued")))).otherwise(F.array().cast("array<string>")).alias("words"))
    coded = with_windows(with_windows(coded, "tokens", widths, "c"), "words", widths, "p")
    # All windows by template, width after width, then those by words where these differ, else null.
    by_template = F.concat(*[F.col(f"c{w}") for w in widths])
    by_words = F.concat(*[F.zip_with(f"c{w}", f"p{w}", lambda c, p: F.when(c != p, p)) for w in widths])
    found = coded.select("doc_id", "text_hash", F.size("tokens").alias("n"), F.posexplode(
        F.when(F.size("words") > 0, F.concat(by_template, by_words)).otherwise(by_template)).alias("p", "h"))
    wanted = items.select("item_id", "item", "kind", "width", "q", "h", "n_windows", "exact", F.size("slots").alias("n_slots"))
    size = lambda w: F.greatest(F.col("n") - (w - 1), F.lit(0))
    before, total = F.lit(0), F.lit(0)
    for w in widths:
        before = F.when(F.col("width") > w, before + size(w)).otherwise(before)
        total = total + size(w)
    hits = found.join(wanted, "h").withColumn("p", F.col("p") % total - before).where((F.col("p") >= 0) & (F.col("p") < F.col("n") - F.col("width") + 1))
    hits = stored(occurrences(hits.select("doc_id", "text_hash", "p", "item_id", "item", "kind", "q", "n_windows", "exact", "n_slots")), "decontam-hits")
    whole = (hits.groupBy("doc_id", "text_hash", "item_id", "item", "of_words", "exact", "occurrence")
             .agg(F.count_distinct("q").alias("n_hits"), F.max("n_windows").alias("n_windows"))
             .where(F.when(F.col("exact"), (F.col("n_hits") == F.col("n_windows")) & F.col("occurrence").startswith("start"))
                    .otherwise(F.col("n_hits") >= F.lit(min_share) * F.col("n_windows"))))
    odd = inconsistent(base, items, hits)
    same = (F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_hash")) & (F.col("i") == F.col("item"))
            & (F.col("o") == F.col("occurrence")) & ~F.col("of_words"))
    # Of a copy that both ways show, the template's figures are given.
    best = F.min(F.struct("of_words", -F.col("n_hits"), "n_hits", "n_windows"))
    return (whole.join(odd, same, "left_anti").groupBy("doc_id", "text_hash", "item_id", "item").agg(best.alias("best"))
            .select("doc_id", "text_hash", "item_id", "best.n_hits", "best.n_windows"))


def occurrences(hits: DataFrame) -> DataFrame:
    """The hits under each occurrence they are part of: the document, their start, and the run of starts not half an item apart."""
    start = F.col("p") - F.col("q")
    hits = hits.withColumn("of_words", F.col("kind") == 2)
    by_start = Window.partitionBy("doc_id", "text_hash", "item", "of_words").orderBy(start)
    gap = start - F.lag(start).over(by_start)
    runs = (hits.distinct().withColumn("begins", F.when(gap * 2 > F.col("n_windows"), 1).otherwise(0))
            .withColumn("run", F.sum("begins").over(by_start)))
    labels = F.array(F.lit("all"), F.concat(F.lit("start "), start.cast("string")), F.concat(F.lit("run "), F.col("run").cast("string")))
    return runs.withColumn("occurrence", F.explode(labels)).drop("begins", "run")


def inconsistent(base: DataFrame, items: DataFrame, hits: DataFrame) -> DataFrame:
    """d, t, i, o: documents (id, text hash), items and occurrences whose slot values don't map one to one."""
    slotted = stored(hits.where("n_slots > 0").select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), F.col("occurrence").alias("o"), "item", "kind", "p", "q").distinct(), "decontam-slots")
    texts = base.withColumn("text_hash", F.xxhash64("text"))
    keys = slotted.select("d", "t").distinct()
    values = (texts.join(keys, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")))
              .select("d", "t", _words(valued(F.col("text"))).alias("values")).dropDuplicates(["d", "t"]))
    pairs = (slotted.join(items.select(F.col("item").alias("i"), F.col("kind").alias("ik"), F.col("q").alias("iq"), F.explode("slots").alias("slot")),
                          (F.col("item") == F.col("i")) & (F.col("kind") == F.col("ik")) & (F.col("q") == F.col("iq")))
             .select("d", "t", "i", "o", (F.col("p") + F.col("slot.k")).alias("at"), F.col("slot.value").alias("item_value")).distinct()
             .withColumnsRenamed({"d": "pd", "t": "pt"}))
    met = (pairs.join(values, F.col("pd").eqNullSafe(F.col("d")) & (F.col("pt") == F.col("t")))
           .select("d", "t", "i", "o", "item_value", F.get("values", F.col("at")).alias("doc_value")).distinct())
    return (met.groupBy("d", "t", "i", "o").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("item_value").alias("a"), F.count_distinct("doc_value").alias("b"))
            .where("n <> a or n <> b").select("d", "t", "i", "o"))


def clean_stage(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns (pipeline stage)."""
    bad = stored(matches(docs, benchmark, **options).select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t")).distinct(), "decontam-bad")
    same = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__t"))
    return docs.join(bad, same, "left_anti")
