"""URL filters: given host and path rules, then association rules mined from labels by Spark's FP-growth.

Labels belong to pages: those that the caller gives by page id, or, without any, what the given rules say of the pages that they cover, so that the
mined rules carry the given ones' verdicts on to pages alike that no rule covers.

A url becomes a set of tokens: host labels, the last two host labels together, all path
segments without digits, the file extension and the names of all query parameters. FP-growth finds token sets frequent among
labelled pages; the rules "tokens => bad" with enough support, confidence and lift remain, less those
that a rule with fewer of the same tokens and no less confidence makes needless. Rules are matched
through an inverted index: each lies under its rarest token, distinct token sets are joined to it by
their tokens, and a hit counts if the set holds all tokens of the rule. Pages join the few matched
token sets, never the rules, so a host with a third of all pages costs one match.

Only DataFrame functions and Spark's own FP-growth run; nothing is a Python function.

Defined cases: a null url or one without "://" has an empty host and path and no tokens, so no rule fits and it is allowed; repeated
page ids and urls are judged row by row; null labels are no labels, and of a page labelled twice any
bad label counts; with no labelled page nothing is mined; extra columns are ignored; of mined rules
that match, the one of most confidence, then support, then least text is named.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwave.llm.common import stored

BAD = "label:bad"


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and its subdomains where the url's path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query, longest first at matching.
RULES = (HostRule("com", "/", "allow"), HostRule("example.com", "/en/", "block"),
         HostRule("www.example.com", "/en/", "allow"), HostRule("net", "/es/", "block"), HostRule("net", "/fr/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return (F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), upper, lower),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The sorted token set of a url."""
    labels = F.filter(F.split(F.regexp_replace(host, ":[0-9]*$", ""), "\\."), lambda x: x != "")
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    parts = F.filter(F.split(F.lower(path), "/"), lambda x: (x != "") & ~x.rlike("[0-9]"))
    ext = F.regexp_extract(F.lower(path), "\\.([a-z0-9]{1,5})$", 1)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), "\\?([^#]*)", 1)
    names = F.array_distinct(F.filter(F.transform(F.split(F.lower(query), "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != ""))
    found = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)),
        F.when(F.size(labels) > 1, F.array(F.concat(F.lit("d:"), domain))).otherwise(F.array().cast("array<string>")),
        F.transform(parts, lambda x: F.concat(F.lit("p:"), x)),
        F.when(ext != "", F.array(F.concat(F.lit("e:"), ext))).otherwise(F.array().cast("array<string>")),
        F.transform(names, lambda x: F.concat(F.lit("q:"), x)))
    return F.array_sort(F.array_distinct(found))


def fitting_rule(host: Column, path: Column, rules: tuple[HostRule, ...]) -> Column:
    """The longest given rule that fits, as struct(text, verdict), or null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    out = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in reversed(ordered):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def parsed(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    url = F.col("url")
    df = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    host, path = host_and_path(url)
    df = df.withColumns({"host": host, "path": path})
    return df.withColumn("tokens", tokens(url, F.col("host"), F.col("path")))


def mine(urls: DataFrame, labels: DataFrame, label_id: str = "doc_id", bad: Column | None = None,
         min_support: float = 0.002, min_count: int = 8, min_confidence: float = 0.6, min_lift: float = 1.5) -> DataFrame:
    """Rules: antecedent (sorted tokens), confidence, support, lift, anchor (its rarest token)."""
    bad = bad if bad is not None else (F.col("quality") == 0) | (F.col("toxic") == 1)
    judged = (labels.select(F.col(f"`{label_id}`").alias("page_id"), bad.alias("bad")).where("page_id is not null and bad is not null")
              .groupBy("page_id").agg(F.max("bad").alias("bad")))
    return mine_labelled(urls.select("page_id", "tokens").join(judged, "page_id"), min_support, min_count, min_confidence, min_lift)


def covered(urls: DataFrame, rules: tuple[HostRule, ...]) -> DataFrame:
    """tokens, bad of the urls that a given rule fits."""
    given = fitting_rule(F.col("host"), F.col("path"), rules)
    return urls.select("tokens", given.alias("given")).where("given is not null").select("tokens", (F.col("given.verdict") == "block").alias("bad"))


def mine_labelled(labelled: DataFrame, min_support: float = 0.002, min_count: int = 8, min_confidence: float = 0.6, min_lift: float = 1.5) -> DataFrame:
    """Like ``mine``, from rows of tokens and bad."""
    rows = (labelled.select(F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items"))
            .where(F.size("items") > 0))
    n = rows.count()
    spark = labelled.sparkSession
    if n == 0:
        return spark.createDataFrame([], "antecedent array<string>, confidence double, support double, lift double, anchor string")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, min_count / n)), minConfidence=min_confidence).fit(rows)
    sets = model.freqItemsets
    rarity = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rules = (model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD) & (F.col("lift") >= min_lift))
             .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support", "lift"))
    shorter = rules.select(F.col("antecedent").alias("small"), F.col("confidence").alias("small_confidence"))
    # A rule is needless if one of its proper subsets, found by leaving tokens out one at a time, is as sure.
    fewer = (rules.select("antecedent", "confidence", F.explode("antecedent").alias("out"))
             .select("antecedent", "confidence", F.array_remove(F.col("antecedent"), F.col("out")).alias("small")))
    needless = fewer.join(shorter, "small").where("small_confidence >= confidence").select("antecedent").distinct()
    rules = rules.join(needless, "antecedent", "left_anti")
    return (rules.select("*", F.explode("antecedent").alias("token")).join(rarity, "token")
            .groupBy("antecedent", "confidence", "support", "lift")
            .agg(F.min_by("token", F.struct("freq", "token")).alias("anchor")))


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """tokens, mined (struct confidence, support, text) for each distinct token set that a rule matches."""
    sets = urls.select("tokens").where(F.size("tokens") > 0).distinct()
    hits = (sets.select("tokens", F.explode("tokens").alias("anchor")).join(rules, "anchor")
            .where(F.size(F.array_except("antecedent", "tokens")) == 0))
    best = F.struct(-F.col("confidence"), -F.col("support"), F.array_join("antecedent", " "))
    return hits.groupBy("tokens").agg(F.min_by(F.struct("confidence", "support", F.array_join("antecedent", " ").alias("text")), best).alias("mined"))


def judge(pages: DataFrame, labels: DataFrame | None = None, rules: tuple[HostRule, ...] = RULES, id_col: str = "page_id",
          url_col: str = "url", mined_rules: DataFrame | None = None, **mining) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule, confidence for every page; without ``labels`` the given rules' verdicts are the labels."""
    # Stored once: mining, matching and judging read the tokens again.
    urls = stored(parsed(pages, id_col, url_col), "url-tokens")
    if mined_rules is not None:
        mined = mined_rules
    else:
        mined = mine_labelled(covered(urls, rules), **mining) if labels is None else mine(urls, labels, **mining)
    # Stored first: the join below then sees its true size and may split hot token sets of the pages.
    hits = stored(match(urls, mined).withColumnRenamed("tokens", "set"), "url-hits")
    given = fitting_rule(F.col("host"), F.col("path"), rules)
    out = urls.withColumn("given", given).join(hits, F.col("tokens") == F.col("set"), "left")
    verdict = F.coalesce(F.col("given.verdict"), F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
    return out.select(F.col("page_id").alias(id_col), "host", "path", F.col("given.text").alias("rule"), verdict.alias("verdict"),
                      F.col("mined.text").alias("mined_rule"), F.col("mined.confidence").alias("confidence"))
