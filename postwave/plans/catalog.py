"""Named batch queries over the test tables: ``(spark, sf_dir) -> DataFrame``.

Each query starts from the envelope (or roster) lines that Spark derives from the whole tables and
runs the library on them, so its work grows with the data. Output columns are flat (strings, ints,
doubles) so they can be compared with the DuckDB oracle in ``postwave.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.functions import sentence_ends, sentence_model
from postwave.functions import sentiment as S
from postwave.functions.timekeys import hour_key
from postwave.operators import lastn, metrics as M, parse
from postwave.operators.rules import roster_rules
from postwave.operators.upsert import upsert_merge
from postwave.plans import sql_surface
from postwave.session import checkpoint_root
from postwave.sources import envelopes, roster, tables

HOUR = ["year", "month", "day", "hour"]
# Word lists of the sentence checks: words that the documents hold, so that all classes occur.
CHECK_WORDS = (("the", "und", "la", "que", "is", "est"), ("of", "der", "de", "en", "that", "les"))


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_lines(tables.envelope_lines(spark, sf_dir))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.posts(parsed_lines(spark, sf_dir))


def _metric(spec: M.MetricSpec) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: M.metric_from_spec(posts(spark, sf_dir), spec)


def q_media_by_hour_party(spark, sf_dir):
    return M.media_by_hour_party(M.metric_from_spec(posts(spark, sf_dir), M.MEDIA_BY_KIND_HOUR_PARTY))


def q_sentiment_by_hour_party(spark, sf_dir):
    out = M.sentiment_by_hour_party(posts(spark, sf_dir))
    return out.withColumn("sentiment", F.round("sentiment", 9))


def q_scored_sentiment_by_hour_party(spark, sf_dir):
    out = M.sentiment_by_hour_party(posts(spark, sf_dir), include_unscored=False)
    return out.withColumn("sentiment", F.round("sentiment", 9))


def q_last15_by_party(spark, sf_dir):
    return lastn.last_n_by_party(posts(spark, sf_dir)).drop("ts")


def q_last15_combined(spark, sf_dir):
    return lastn.last_n_combined(posts(spark, sf_dir)).drop("ts")


def q_parse_posts(spark, sf_dir):
    p = posts(spark, sf_dir)
    return p.select("id", "user_id", "username", "name", "party", "createdDate", "in_reply_to_user_id", "source",
                    "attachments", "sentiment", F.array_join("hashtags", ",").alias("hashtags"),
                    F.size("users").alias("n_users"), F.char_length("text").alias("text_chars"))


def q_valid_posts(spark, sf_dir):
    return posts(spark, sf_dir).select("id", "party")


def q_rejected_posts(spark, sf_dir):
    return parse.rejects(parsed_lines(spark, sf_dir)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def q_error_envelopes(spark, sf_dir):
    r = parse.rejects(parsed_lines(spark, sf_dir)).where(F.col("reason") == "error_envelope")
    return r.groupBy("error_title", "error_action").agg(F.count(F.lit(1)).alias("n"))


def q_party_tag(spark, sf_dir):
    return posts(spark, sf_dir).groupBy("party").agg(F.count(F.lit(1)).alias("n"))


def q_hashtags_of_post(spark, sf_dir):
    p = posts(spark, sf_dir).select("id", F.posexplode("hashtags").alias("p", "hashtag"))
    return p.select("id", (F.col("p") + 1).alias("pos"), "hashtag")


def q_post_document(spark, sf_dir):
    d = parse.post_document(posts(spark, sf_dir))
    return d.select("id", "user_id", "username", "party", "attachments",
                    F.col("users")[0]["id"].alias("first_user_id"), F.size("hashtags").alias("n_hashtags"))


def q_json_roundtrip(spark, sf_dir):
    back = parse.from_document_json(parse.to_document_json(parse.post_document(posts(spark, sf_dir))))
    return back.select("id", "username", "party", "attachments", "sentiment",
                       F.array_join("hashtags", ",").alias("hashtags"))


def q_hour_key(spark, sf_dir):
    p = posts(spark, sf_dir)
    return p.select(*hour_key(F.col("created_ts"))).groupBy(*HOUR).agg(F.count(F.lit(1)).alias("count"))


def _documents(spark, sf_dir):
    return tables.read_table(spark, sf_dir, "documents").select("doc_id", "text")


def q_sentences(spark, sf_dir):
    d = _documents(spark, sf_dir).select("doc_id", S.sentences(F.col("text")).alias("s"))
    return d.select("doc_id", F.size("s").alias("n_sentences"),
                    F.aggregate(F.transform("s", lambda x: F.char_length(x)), F.lit(0).cast("bigint"),
                                lambda a, x: a + x).alias("total_len"))


def q_sentences_learned(spark, sf_dir):
    """Sentences that end where the documents' own abbreviations don't stand."""
    docs = _documents(spark, sf_dir)
    d = docs.select("doc_id", sentence_ends.split(F.col("text"), sentence_ends.fit(docs)).alias("s"))
    return d.select("doc_id", F.size("s").alias("n_sentences"),
                    F.aggregate(F.transform("s", lambda x: F.char_length(x)), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total_len"))


def q_sentence_scores(spark, sf_dir):
    d = _documents(spark, sf_dir).select("doc_id", F.explode(S.scored_sentences(F.col("text"), *CHECK_WORDS)).alias("x"))
    return d.select("doc_id", F.col("x.pos").alias("pos"), F.col("x.len").alias("len"), F.col("x.cls").alias("cls"))


def q_trained_sentence_scores(spark, sf_dir):
    """Sentence classes of a model fitted on labelled documents (toxic: 0, poor: 2, else 4)."""
    labels = tables.read_table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 2).otherwise(4).alias("cls"))
    docs = _documents(spark, sf_dir)
    model = sentence_model.fit(sentence_model.labelled_sentences(docs, labels))
    parts = docs.select("doc_id", F.posexplode(S.sentences(F.col("text"))).alias("pos", "s"))
    scored = parts.select("doc_id", (F.col("pos") + 1).alias("pos"), model.scores(F.col("s")).alias("x"))
    return scored.select("doc_id", "pos", (F.array_position("x", F.array_max("x")) - 1).cast("int").alias("cls"), F.array_max("x").alias("score"))


def q_doc_sentiment(spark, sf_dir):
    d = S.with_sentiment(_documents(spark, sf_dir), "text", "sentiment", "mean_sentiment", "main_sentiment",
                         positive=CHECK_WORDS[0], negative=CHECK_WORDS[1])
    return d.drop("text")


def q_sentiment_label(spark, sf_dir):
    d = S.with_sentiment(_documents(spark, sf_dir), "text", "sentiment", positive=CHECK_WORDS[0], negative=CHECK_WORDS[1])
    return d.groupBy(S.sentiment_label(F.col("sentiment")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def q_roster_load(spark, sf_dir):
    return roster.load_roster(tables.roster_lines(spark, sf_dir))


def _roster(spark, sf_dir):
    return roster.dedup_roster(roster.load_roster(tables.roster_lines(spark, sf_dir)))


def q_roster_dedup(spark, sf_dir):
    return _roster(spark, sf_dir)


def q_roster_file_order(spark, sf_dir):
    """Roster files that list each account three times, in no order, read in many small splits: the later line wins."""
    path = f"{checkpoint_root(spark)}/roster-{uuid.uuid4().hex}"
    tables.land_roster_files(spark, sf_dir, path)
    key, small = "spark.sql.files.maxPartitionBytes", "16384"
    old = spark.conf.get(key)
    spark.conf.set(key, small)
    try:
        lines = roster.line_numbers(roster.read_roster_lines(spark, path))
    finally:
        spark.conf.set(key, old)
    listed = roster.load_roster(lines)
    kept = roster.dedup_roster(listed, ("version", "block", "at"))
    return kept.select("user_id", "party").join(listed.select("user_id", "party", "line"), ["user_id", "party"])


def q_roster_rules(spark, sf_dir):
    return roster_rules(_roster(spark, sf_dir))


def q_replay_unwrap(spark, sf_dir):
    lines = envelopes.replay_envelopes(tables.replay_lines(spark, sf_dir))
    return parse.posts(parse.parse_lines(lines)).select("id", "party")


def q_ingest_counts(spark, sf_dir):
    p = parsed_lines(spark, sf_dir)
    return p.agg(F.count(F.lit(1)).alias("lines"),
                 F.count_if(F.col("reject_reason").isNull()).alias("valid"),
                 F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
                 F.count_if(F.col("reject_reason") == "error_envelope").alias("error_envelopes"))


def q_raw_landing(spark, sf_dir):
    """K2: envelopes landed with a parsed copy (VARIANT, shredded) beside the raw text, read back from the table."""
    path = f"{checkpoint_root(spark)}/raw-{uuid.uuid4().hex}"
    parse.write_raw_landing(posts(spark, sf_dir), path)
    p = spark.read.parquet(path)
    return p.select("id", F.variant_get("parsed", "$.data.id", "string").alias("landed_id"),
                    F.variant_get("parsed", "$.data.author_id", "string").alias("landed_author_id"))


def q_last15_documents(spark, sf_dir):
    """Both scopes as documents; the overall list is within the parties' lists (a few rows, checkpointed as they are read twice)."""
    checkpoint_root(spark)
    by_party = lastn.last_n_by_party(posts(spark, sf_dir)).checkpoint(eager=True)
    combined = lastn.last_n_combined(by_party.withColumnRenamed("ts", "created_ts"))
    docs = lastn.as_lists(by_party).unionByName(lastn.as_lists(combined, None))
    return docs.select("scope", "party", F.array_join("tweetIds", ",").alias("tweet_ids"))


def q_metric_from_sql(spark, sf_dir):
    """A metric that no MetricSpec can say (posts, distinct users and mean scored sentiment by source), declared in SQL text."""
    sql_surface.register(spark, posts(spark, sf_dir))
    return spark.sql("""
        SELECT year, month, day, hour, party, source, count(*) AS posts, count(DISTINCT username) AS users, round(avg(scored(sentiment)), 9) AS mean_sentiment
        FROM hourly_posts(DATE'1900-01-01', DATE'2999-12-31') GROUP BY year, month, day, hour, party, source""")


def q_metric_documents(spark, sf_dir):
    spec = M.POSTS_BY_HOUR_PARTY
    return M.as_documents(M.metric_from_spec(posts(spark, sf_dir), spec), spec, as_json=True)


def q_upsert_merge(spark, sf_dir):
    """A3 kept by replace-by-key: an older run over days 1-19, with counts twice too high, and a newer
    run from day 15 on, whose hours replace the older ones. Both runs' counts come from one parse and one aggregate, which is
    checkpointed (hours x parties rows) because the merge reads the newer run twice."""
    checkpoint_root(spark)
    p = posts(spark, sf_dir)
    day = F.dayofmonth(F.to_date(F.col("createdDate").substr(1, 10)))
    runs = (p.select(*hour_key(F.col("created_ts")), "party", (day < 20).alias("in_old"), (day >= 15).alias("in_new"))
            .groupBy(*HOUR, "party")
            .agg((F.count_if("in_old") * 2).alias("old_count"), F.count_if("in_new").alias("new_count"))
            .checkpoint(eager=True))
    old = runs.where("old_count > 0").select(*HOUR, "party", F.col("old_count").alias("count"))
    new = runs.where("new_count > 0").select(*HOUR, "party", F.col("new_count").alias("count"))
    return upsert_merge(old, new, HOUR + ["party"])


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "posts_by_hour_party": _metric(M.POSTS_BY_HOUR_PARTY),
    "hashtags_by_hour": _metric(M.HASHTAGS_BY_HOUR),
    "hashtags_by_hour_party": _metric(M.HASHTAGS_BY_HOUR_PARTY),
    "media_by_kind_hour_party": _metric(M.MEDIA_BY_KIND_HOUR_PARTY),
    "media_by_hour_party": q_media_by_hour_party,
    "active_users_by_hour_party": _metric(M.ACTIVE_USERS_BY_HOUR_PARTY),
    "sentiment_by_hour_party": q_sentiment_by_hour_party,
    "scored_sentiment_by_hour_party": q_scored_sentiment_by_hour_party,
    "source_by_hour_party": _metric(M.SOURCE_BY_HOUR_PARTY),
    "last15_by_party": q_last15_by_party,
    "last15_combined": q_last15_combined,
    "parse_posts": q_parse_posts,
    "valid_posts": q_valid_posts,
    "rejected_posts": q_rejected_posts,
    "error_envelopes": q_error_envelopes,
    "party_tag": q_party_tag,
    "hashtags_of_post": q_hashtags_of_post,
    "post_document": q_post_document,
    "json_roundtrip": q_json_roundtrip,
    "hour_key": q_hour_key,
    "sentences": q_sentences,
    "sentences_learned": q_sentences_learned,
    "sentence_scores": q_sentence_scores,
    "trained_sentence_scores": q_trained_sentence_scores,
    "doc_sentiment": q_doc_sentiment,
    "sentiment_label": q_sentiment_label,
    "roster_load": q_roster_load,
    "roster_dedup": q_roster_dedup,
    "roster_file_order": q_roster_file_order,
    "roster_rules": q_roster_rules,
    "replay_unwrap": q_replay_unwrap,
    "ingest_counts": q_ingest_counts,
    "raw_landing": q_raw_landing,
    "last15_documents": q_last15_documents,
    "metric_documents": q_metric_documents,
    "metric_from_sql": q_metric_from_sql,
    "upsert_merge": q_upsert_merge,
}
