"""Envelope lines to posts (P1-P8, P14, P16) and the quarantine split.

``parse_lines`` parses each line once; ``posts`` and ``rejects`` are two projections of the same
parsed frame. ``classify`` gives both in one frame (a ``kind`` column) so an ingest job writes
posts and quarantine in a single pass over the input, with no cache of the parsed lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwave.functions import envelope as E
from postwave.functions import sentiment as S
from postwave.functions.exprs import once
from postwave.functions.timekeys import parse_created_at

POST_COLUMNS = ("id", "text", "user_id", "username", "name", "hashtags", "users", "party", "createdDate",
                "in_reply_to_user_id", "source", "sentiment", "attachments", "json", "created_ts")


def parse_lines(lines: DataFrame, value_col: str = "value", strict: bool = False) -> DataFrame:
    """Adds ``env`` (parsed struct), ``sub`` (parsed entities and attachments), ``tags`` (hashtag
    objects) and ``reject_reason``. Each JSON text is parsed exactly once.

    ``strict=True`` also rejects posts whose fields that must be strings (of ``data``, of a user, the
    rule tag that counts) hold another JSON type; by default such values are read as their text."""
    if strict:
        parsed = lines.select("*", once(E.parse_envelope_strict(F.col(value_col)), "_env_v"))
        parsed = parsed.select(*lines.columns, once(E.strict_view(F.col("_env_v")), "env"))
    else:
        parsed = lines.select("*", once(E.parse_envelope(F.col(value_col)), "env"))
    data = F.col("env")["data"]
    parsed = parsed.select("*", once(F.struct(E.entities(data).alias("ents"), E.attachments_map(data).alias("att")),
                                      "sub"))
    parsed = parsed.select("*", once(E.hashtag_objects(F.col("sub.ents")), "tags"))
    return parsed.withColumn("reject_reason", E.reject_reason(F.col("env"), F.col("sub.ents"), F.col("sub.att"),
                                                              F.col("tags"), parse_created_at(data["created_at"]), strict))


POST_COLUMNS_STAGED = tuple("_sentiment_parts" if c == "sentiment" else c for c in POST_COLUMNS)


def _post_columns(value: Column, env: Column, sub: Column, tags: Column, keep_null_tags: bool) -> list[Column]:
    data = env["data"]
    users = env["includes"]["users"]
    who = E.author(users, data["author_id"])
    return [
        data["id"].alias("id"),
        data["text"].alias("text"),
        data["author_id"].alias("user_id"),
        who["username"].alias("username"),
        who["name"].alias("name"),
        E.hashtags(tags, keep_null_tags).alias("hashtags"),
        E.users_list(users).alias("users"),
        E.party_tag(env["matching_rules"]).alias("party"),
        data["created_at"].alias("createdDate"),
        E.reply_to(data).alias("in_reply_to_user_id"),
        data["source"].alias("source"),
        S.sentiment_parts(data["text"]).alias("_sentiment_parts"),
        E.attachment_count(sub["att"]).alias("attachments"),
        value.alias("json"),
        parse_created_at(data["created_at"]).alias("created_ts"),
    ]


def _finish_sentiment(staged: DataFrame) -> DataFrame:
    """Second projection: the sentiment fold ran once into ``_sentiment_parts``; the mean reads the
    parts from that column (Spark keeps the two projections apart because the fold is not cheap)."""
    return staged.select(*[S.weighted_from_parts(F.col(c)).alias("sentiment") if c == "_sentiment_parts" else c
                           for c in staged.columns])


def posts(parsed: DataFrame, value_col: str = "value", keep_null_tags: bool = False) -> DataFrame:
    """The valid rows as the 14 post columns plus ``created_ts`` (event time)."""
    cols = _post_columns(F.col(value_col), F.col("env"), F.col("sub"), F.col("tags"), keep_null_tags)
    return _finish_sentiment(parsed.where(F.col("reject_reason").isNull()).select(*cols))


def rejects(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    """Quarantine: raw line, reason, and for error envelopes the last title and the action."""
    title = E.error_title(F.col("env")["errors"])
    is_err = F.col("reject_reason") == F.lit("error_envelope")
    return (parsed.where(F.col("reject_reason").isNotNull())
            .select(F.col(value_col).alias("line"), F.col("reject_reason").alias("reason"),
                    F.when(is_err, title).alias("error_title"),
                    F.when(is_err, E.error_action(title)).alias("error_action")))


def classify(parsed: DataFrame, value_col: str = "value", keep_null_tags: bool = False) -> DataFrame:
    """Every line once: post columns (null for rejects; ``json`` is the raw line for both) plus
    ``kind`` ('post' or 'reject'), ``reason``, ``error_title`` and ``error_action``."""
    valid = F.col("reject_reason").isNull()
    cols = _post_columns(F.col(value_col), F.col("env"), F.col("sub"), F.col("tags"), keep_null_tags)
    cols = [c if name == "json" else F.when(valid, c).alias(name) for c, name in zip(cols, POST_COLUMNS_STAGED)]
    title = E.error_title(F.col("env")["errors"])
    is_err = F.col("reject_reason") == F.lit("error_envelope")
    return _finish_sentiment(parsed.select(
        *cols, F.when(valid, F.lit("post")).otherwise(F.lit("reject")).alias("kind"),
        F.col("reject_reason").alias("reason"), F.when(is_err, title).alias("error_title"),
        F.when(is_err, E.error_action(title)).alias("error_action")))


def _quoted(text: Column) -> Column:
    """``text`` as a JSON string, quotes included (its own brackets stand within them)."""
    return F.btrim(F.to_json(F.array(text)), F.lit("[]"))


def text_once(classified: DataFrame) -> DataFrame:
    """For a table: ``json`` is stored as what stands before and after its text (``json_before``, ``json_after``), since ``text`` holds that already;
    a line that doesn't hold its text as ``_quoted`` gives it (escaped otherwise, or a reject) stays whole in ``json``. ``whole_json`` puts it together."""
    names = [c for c in classified.columns if c != "json"]
    staged = classified.withColumn("_q", _quoted(F.col("text")))
    staged = staged.withColumn("_at", F.when(F.col("text").isNotNull(), F.instr("json", F.col("_q"))).otherwise(0))
    found = F.col("_at") > 0
    return staged.select(
        *names, F.when(~found, F.col("json")).alias("json"), F.when(found, F.substring("json", 1, F.col("_at") - 1)).alias("json_before"),
        F.when(found, F.substr("json", F.col("_at") + F.length("_q"))).alias("json_after"))


def whole_json() -> Column:
    """The raw line of a row that ``text_once`` has made."""
    return F.coalesce("json", F.concat("json_before", _quoted(F.col("text")), "json_after")).alias("json")


def raw_landing(posts_df: DataFrame) -> DataFrame:
    """K2: id, raw envelope text, and the envelope parsed once more as VARIANT."""
    return posts_df.select("id", "json", F.try_parse_json("json").alias("parsed"))


def parse_posts(lines: DataFrame, value_col: str = "value") -> DataFrame:
    return posts(parse_lines(lines, value_col), value_col)


def post_document(posts_df: DataFrame) -> DataFrame:
    """The stored document: every column but ``json``; user keys are id, username, name."""
    users = F.transform(F.col("users"), lambda u: F.struct(u["user_id"].alias("id"), u["username"].alias("username"),
                                                           u["name"].alias("name")))
    return posts_df.select("id", "text", "user_id", "username", "name", "hashtags", users.alias("users"), "party",
                           "createdDate", "in_reply_to_user_id", "source", "sentiment", "attachments")


def to_document_json(docs: DataFrame) -> DataFrame:
    """P16 serialise: one JSON text per document, keyed by id."""
    return docs.select("id", F.to_json(F.struct(*[F.col(c) for c in docs.columns])).alias("doc_json"))


DOCUMENT_SCHEMA = ("id string, text string, user_id string, username string, name string, hashtags array<string>, "
                   "users array<struct<id:string,username:string,name:string>>, party string, createdDate string, "
                   "in_reply_to_user_id string, source string, sentiment double, attachments int")


def from_document_json(js: DataFrame) -> DataFrame:
    """P16 parse back."""
    return js.select(F.from_json("doc_json", DOCUMENT_SCHEMA).alias("d")).select("d.*")


#: Settings under which a VARIANT is written shredded: its frequent fields as Parquet columns of their own.
SHREDDING = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}


def write_raw_landing(posts_df: DataFrame, path: str) -> None:
    """K2 as Parquet, the parsed envelopes shredded: what is read of them later (``$.data.author_id``) is one column chunk, not the whole value."""
    conf = posts_df.sparkSession.conf
    old = {k: conf.get(k) for k in SHREDDING}
    try:
        for k, v in SHREDDING.items():
            conf.set(k, v)
        raw_landing(posts_df).write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in old.items():
            conf.set(k, v)
