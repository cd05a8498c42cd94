"""DuckDB SQL for each catalog query, computed from the base tables without any JSON.

The oracle drops the broken lines by the same ``event_id`` rule the line builder uses and reads
every value straight from ``events``/``documents``/``customer``; so the Spark side's envelope
building, parsing and validation are checked against SQL that never sees an envelope.
"""

from __future__ import annotations

from postwave.functions import sentence_ends as SE
from postwave.functions import sentence_model as SM
from postwave.functions import sentiment as S
from postwave.plans.catalog import CHECK_WORDS
from postwave.sources import tables as TB


def _words(ws) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in ws)


def _sentences(text: str) -> str:
    pat = S.SENTENCE_PATTERN.replace("\\\\", "\\")
    return (f"list_filter(list_transform(regexp_extract_all(coalesce({text}, ''), '{pat}'), "
            f"lambda s: trim(s)), lambda s: s <> '')")


def _class(s: str, positive=S.POSITIVE_WORDS, negative=S.NEGATIVE_WORDS) -> str:
    toks = f"regexp_extract_all(lower({s}), '{S.TOKEN_PATTERN}')"
    pos = f"len(list_filter({toks}, lambda t: t IN ({_words(positive)})))"
    neg = f"len(list_filter({toks}, lambda t: t IN ({_words(negative)})))"
    net = f"({pos} - {neg})"
    return (f"(CASE WHEN {net} <= -2 THEN 0 WHEN {net} = -1 THEN 1 WHEN {net} = 0 THEN 2 "
            f"WHEN {net} = 1 THEN 3 ELSE 4 END)")


def _scored(text: str, *words) -> str:
    return (f"list_transform({_sentences(text)}, lambda s, i: "
            f"{{'pos': CAST(i AS INTEGER), 'len': CAST(length(s) AS INTEGER), 'cls': CAST({_class('s', *words)} AS INTEGER)}})")


def _weighted(x: str) -> str:
    return (f"(CASE WHEN len({x}) = 0 THEN -1.0 ELSE "
            f"CAST(list_sum(list_transform({x}, lambda e: CAST(e.cls AS BIGINT) * e.len)) AS BIGINT) / "
            f"CAST(list_sum(list_transform({x}, lambda e: CAST(e.len AS BIGINT))) AS BIGINT) END)")


def _mean(x: str) -> str:
    return (f"(CASE WHEN len({x}) = 0 THEN -1.0 ELSE "
            f"CAST(list_sum(list_transform({x}, lambda e: CAST(e.cls AS BIGINT))) AS BIGINT) / len({x}) END)")


def _main(x: str) -> str:
    # class of the longest sentence, first on ties: smallest pos among the longest.
    return (f"(CASE WHEN len({x}) = 0 THEN -1 ELSE "
            f"list_filter({x}, lambda e: e.len = list_max(list_transform({x}, lambda f: f.len)))[1].cls END)")


def _label(s: str) -> str:
    return (f"(CASE WHEN {s} <= 0 THEN 'not_understood' WHEN {s} < 1 THEN 'very_negative' "
            f"WHEN {s} < 2 THEN 'negative' WHEN {s} < 3 THEN 'neutral' WHEN {s} < 4 THEN 'positive' "
            f"WHEN {s} < 5 THEN 'very_positive' ELSE 'not_understood' END)")


_BAD = (f"(event_id % {TB.TRUNCATED_MOD} = 0 OR event_id % {TB.ERROR_MOD} = 0 OR event_id % {TB.NO_SOURCE_MOD} = 0 "
        f"OR event_id % {TB.BAD_TIME_MOD} = 0)")
_TEXT = f"CASE WHEN event_id % {TB.EMPTY_TEXT_MOD} = 0 THEN '' ELSE text END"
_SENT = "(CASE WHEN p.text = '' THEN -1.0 ELSE s.sentiment END)"

BASE = f"""
base AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, d.doc_id, d.text, d.source, d.lang,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k
  FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
),
posts AS (
  SELECT CAST(event_id AS VARCHAR) AS id, {_TEXT} AS text, CAST(user_id AS VARCHAR) AS user_id,
         'user_' || CAST(user_id AS VARCHAR) AS username, 'User ' || CAST(user_id AS VARCHAR) AS name,
         event_type AS party, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS createdDate,
         CASE WHEN k % 5 = 0 THEN 'r' || CAST(user_id AS VARCHAR) ELSE '' END AS in_reply_to_user_id, source, CAST(k % 3 AS INTEGER) AS attachments,
         list_slice(['t' || CAST(k % 10 AS VARCHAR), event_type, lang], 1, k % 4) AS hashtags,
         date_trunc('millisecond', ts) AS ts_ms, event_id, doc_id, k
  FROM base WHERE NOT {_BAD}
),
hposts AS (
  SELECT *, CAST(year(ts_ms) AS INTEGER) AS year, CAST(month(ts_ms) AS INTEGER) AS month,
         CAST(day(ts_ms) AS INTEGER) AS day, CAST(hour(ts_ms) AS INTEGER) AS hour FROM posts
),
docsent AS (
  SELECT doc_id, {_weighted('x')} AS sentiment FROM (SELECT doc_id, {_scored('text')} AS x FROM documents)
)"""

H = "year, month, day, hour"


def _q(body: str) -> str:
    return f"WITH {BASE}\n{body}"


def _roster_base() -> str:
    return """
roster AS (
  SELECT 1 AS version, c_name AS screen_name, CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name,
         c_mktsegment AS party, 'nation ' || CAST(c_nationkey AS VARCHAR) AS location, '2021-01-01' AS created_at
  FROM customer WHERE c_nationkey <> 0
  UNION ALL
  SELECT 2, c_name, CAST(c_custkey AS VARCHAR), c_name, 'INDEPENDENT',
         'nation ' || CAST(c_nationkey AS VARCHAR), '2021-01-01'
  FROM customer WHERE c_acctbal < 0
),
dedup AS (
  SELECT screen_name, user_id, name, party, location, created_at FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY version DESC, screen_name DESC, name DESC,
                                 party DESC, location DESC, created_at DESC) AS rn FROM roster) WHERE rn = 1
)"""


def _trained() -> str:
    """Naive Bayes over hashed words and word pairs, fitted and applied in SQL."""
    words = f"regexp_extract_all(lower(s), '{S.TOKEN_PATTERN}')"
    feats = (f"list_concat({words}, list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))")
    bucket = f"CAST('0x' || substr(md5(f), 1, {SM.HEX_DIGITS}) AS INTEGER)"
    return f"""
    WITH lab AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 2 ELSE 4 END AS cls FROM labels),
    sample AS (SELECT text, cls FROM documents JOIN lab USING (doc_id) WHERE text IS NOT NULL ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT {SM.SAMPLE_TEXTS}),
    sent AS (SELECT cls, unnest({_sentences('text')}) AS s FROM sample),
    counted AS (SELECT cls, {bucket} AS bucket, count(*) AS n FROM (SELECT cls, unnest({feats}) AS f FROM sent) GROUP BY ALL),
    classes AS (SELECT CAST(unnest(range(0, {SM.CLASSES})) AS INTEGER) AS cls),
    totals AS (SELECT cls, (SELECT coalesce(sum(n), 0) FROM counted c WHERE c.cls = classes.cls) AS total FROM classes),
    prior AS (SELECT cls, CAST(round({SM.SCALE} * (ln((SELECT count(*) FROM sent x WHERE x.cls = classes.cls) + 1.0::DOUBLE)
              - ln((SELECT count(*) FROM sent) + {SM.CLASSES}::DOUBLE))) AS BIGINT) AS w FROM classes),
    weights AS (SELECT t.cls, b.bucket, CAST(round({SM.SCALE} * (ln(coalesce(c.n, 0) + 1.0::DOUBLE) - ln(t.total + {SM.BUCKETS}::DOUBLE))) AS BIGINT) AS w
                FROM totals t CROSS JOIN (SELECT CAST(unnest(range(0, {SM.BUCKETS})) AS INTEGER) AS bucket) b LEFT JOIN counted c ON c.cls = t.cls AND c.bucket = b.bucket),
    lines AS (SELECT doc_id, unnest(x) AS s, CAST(unnest(range(1, len(x) + 1)) AS INTEGER) AS pos FROM (SELECT doc_id, {_sentences('text')} AS x FROM documents)),
    found AS (SELECT doc_id, pos, {bucket} AS bucket FROM (SELECT doc_id, pos, unnest({feats}) AS f FROM lines)),
    sums AS (SELECT doc_id, pos, w.cls, sum(w.w) AS w FROM found JOIN weights w USING (bucket) GROUP BY ALL),
    scored AS (SELECT l.doc_id, l.pos, p.cls, CAST(p.w + coalesce(s.w, 0) AS BIGINT) AS score
               FROM lines l CROSS JOIN prior p LEFT JOIN sums s ON s.doc_id = l.doc_id AND s.pos = l.pos AND s.cls = p.cls)
    SELECT doc_id, pos, cls, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, pos ORDER BY score DESC, cls) AS rn FROM scored) WHERE rn = 1"""


def _learned_sentences() -> str:
    """Abbreviations by log-likelihood ratio, then the sentences, in SQL."""
    q = lambda x: x.replace("'", "''")
    mark = "chr(2)"
    toks = (f"list_filter(string_split(regexp_replace(coalesce(text, ''), '[\r\n' || {mark} || ']+', ' ' || {mark} || ' ', 'g'), ' '), lambda t: t <> '')")
    word = lambda t: f"lower(regexp_replace(regexp_replace({t}, '{q(SE.OPENING)}', ''), '\\.$', ''))"
    return f"""
    WITH t AS (SELECT unnest({toks}) AS t FROM documents),
    c AS (SELECT {word('t')} AS word, count(*) FILTER (ends_with(t, '.')) AS n_with, count(*) FILTER (NOT ends_with(t, '.')) AS n_without
          FROM t WHERE t <> {mark} GROUP BY 1 HAVING word <> ''),
    p AS (SELECT sum(n_with)::DOUBLE / sum(n_with + n_without) AS p FROM c),
    s AS (SELECT word, 2 * (n_with * ln({SE.ALWAYS} / p) + n_without * ln((1 - {SE.ALWAYS}::DOUBLE) / (1 - p)))
                 * exp(-length(regexp_replace(word, '[^\\p{{L}}]', '', 'g'))) * (length(word) - length(replace(word, '.', '')) + 1)
                 * power(length(regexp_replace(word, '[^\\p{{L}}]', '', 'g'))::DOUBLE, -n_without::DOUBLE) AS score
          FROM c, p WHERE n_with > 0 AND n_with + n_without >= {SE.LEAST_COUNT} AND regexp_matches(word, '\\p{{L}}')),
    a AS (SELECT coalesce(list(word), []) AS words FROM (SELECT word FROM s WHERE score >= {SE.LEAST_SCORE} ORDER BY score DESC, word LIMIT {SE.MOST})),
    x AS (SELECT doc_id, list_filter(list_transform(string_split(array_to_string(list_transform({toks}, lambda t:
                 CASE WHEN regexp_matches(t, '{q(SE.END)}') AND NOT (ends_with(t, '.') AND list_contains(a.words, {word('t')})) THEN t || {mark} ELSE t END), ' '), {mark}),
                 lambda s: trim(s)), lambda s: s <> '') AS s FROM documents, a)
    SELECT doc_id, CAST(len(s) AS INTEGER) AS n_sentences, CAST(coalesce(list_sum(list_transform(s, lambda x: length(x))), 0) AS BIGINT) AS total_len FROM x"""


_LAST15_BY_PARTY = ("SELECT party, recency, id FROM (SELECT party, id, CAST(row_number() OVER "
                    "(PARTITION BY party ORDER BY ts_ms DESC, id DESC) AS INTEGER) AS recency FROM posts) WHERE recency <= 15")

ORACLE: dict[str, str] = {
    "posts_by_hour_party": _q(f"SELECT {H}, party, count(*) AS count FROM hposts GROUP BY ALL"),
    "hashtags_by_hour": _q(f"SELECT {H}, hashtag, count(*) AS count FROM "
                           f"(SELECT {H}, unnest(hashtags) AS hashtag FROM hposts) GROUP BY ALL"),
    "hashtags_by_hour_party": _q(f"SELECT {H}, hashtag, party, count(*) AS count FROM "
                                 f"(SELECT {H}, party, unnest(hashtags) AS hashtag FROM hposts) GROUP BY ALL"),
    "media_by_kind_hour_party": _q(f"SELECT {H}, attachments, party, count(*) AS count FROM hposts "
                                   f"WHERE attachments <> 0 GROUP BY ALL"),
    "media_by_hour_party": _q(f"SELECT {H}, party, CAST(sum(attachments) AS BIGINT) AS count FROM hposts "
                              f"WHERE attachments <> 0 GROUP BY ALL"),
    "active_users_by_hour_party": _q(f"SELECT {H}, username, party, count(*) AS count FROM hposts GROUP BY ALL"),
    "sentiment_by_hour_party": _q(f"SELECT {H}, party, round(avg({_SENT}), 9) AS sentiment "
                                  f"FROM hposts p JOIN docsent s USING (doc_id) GROUP BY ALL"),
    "scored_sentiment_by_hour_party": _q(
        f"SELECT {H}, party, round(coalesce(avg(CASE WHEN {_SENT} >= 0 THEN {_SENT} END), -1.0), 9) "
        f"AS sentiment FROM hposts p JOIN docsent s USING (doc_id) GROUP BY ALL"),
    "source_by_hour_party": _q(f"SELECT {H}, party, source, count(*) AS count FROM hposts GROUP BY ALL"),
    "last15_by_party": _q("SELECT party, recency, id FROM (SELECT party, id, CAST(row_number() OVER "
                          "(PARTITION BY party ORDER BY ts_ms DESC, id DESC) AS INTEGER) AS recency FROM posts) WHERE recency <= 15"),
    "last15_combined": _q("SELECT CAST(row_number() OVER (ORDER BY ts_ms DESC, id DESC) AS INTEGER) AS recency, id "
                          "FROM posts ORDER BY ts_ms DESC, id DESC LIMIT 15"),
    "parse_posts": _q("SELECT id, user_id, username, name, party, createdDate, in_reply_to_user_id, source, "
                      f"attachments, {_SENT} AS sentiment, array_to_string(hashtags, ',') AS hashtags, 2 AS n_users, "
                      "CAST(length(text) AS INTEGER) AS text_chars FROM posts p JOIN docsent s USING (doc_id)"),
    "valid_posts": _q("SELECT id, party FROM posts"),
    "rejected_posts": _q(f"SELECT CASE WHEN event_id % {TB.TRUNCATED_MOD} = 0 THEN 'malformed_json' "
                         f"WHEN event_id % {TB.ERROR_MOD} = 0 THEN 'error_envelope' "
                         f"WHEN event_id % {TB.NO_SOURCE_MOD} = 0 THEN 'missing_required_field' "
                         f"ELSE 'bad_created_at' END AS reason, count(*) AS n FROM base WHERE {_BAD} "
                         f"GROUP BY ALL"),
    "error_envelopes": _q(f"SELECT CASE WHEN k % 2 = 0 THEN '{TB.DISCONNECT_TITLE}' ELSE '{TB.OTHER_ERROR_TITLE}' END "
                          f"AS error_title, CASE WHEN k % 2 = 0 THEN 'stop' ELSE 'reconnect' END AS error_action, "
                          f"count(*) AS n FROM base WHERE event_id % {TB.TRUNCATED_MOD} <> 0 "
                          f"AND event_id % {TB.ERROR_MOD} = 0 GROUP BY ALL"),
    "party_tag": _q("SELECT party, count(*) AS n FROM posts GROUP BY ALL"),
    "hashtags_of_post": _q("SELECT id, CAST(unnest(generate_series(1, len(hashtags))) AS INTEGER) AS pos, "
                           "unnest(hashtags) AS hashtag FROM posts"),
    "post_document": _q("SELECT id, user_id, username, party, attachments, 'x' || user_id AS first_user_id, "
                        "CAST(len(hashtags) AS INTEGER) AS n_hashtags FROM posts"),
    "json_roundtrip": _q(f"SELECT id, username, party, attachments, {_SENT} AS sentiment, "
                         "array_to_string(hashtags, ',') AS hashtags FROM posts p JOIN docsent s USING (doc_id)"),
    "hour_key": _q(f"SELECT {H}, count(*) AS count FROM hposts GROUP BY ALL"),
    "sentences": f"SELECT doc_id, CAST(len(s) AS INTEGER) AS n_sentences, "
                 f"CAST(coalesce(list_sum(list_transform(s, lambda x: length(x))), 0) AS BIGINT) AS total_len "
                 f"FROM (SELECT doc_id, {_sentences('text')} AS s FROM documents)",
    "sentence_scores": f"SELECT doc_id, e.pos AS pos, e.len AS len, e.cls AS cls FROM "
                       f"(SELECT doc_id, unnest({_scored('text', *CHECK_WORDS)}) AS e FROM documents)",
    "trained_sentence_scores": _trained(),
    "sentences_learned": _learned_sentences(),
    "doc_sentiment": f"SELECT doc_id, {_weighted('x')} AS sentiment, {_mean('x')} AS mean_sentiment, "
                     f"CAST({_main('x')} AS INTEGER) AS main_sentiment "
                     f"FROM (SELECT doc_id, {_scored('text', *CHECK_WORDS)} AS x FROM documents)",
    "sentiment_label": f"SELECT {_label('sentiment')} AS label, count(*) AS n FROM "
                       f"(SELECT {_weighted('x')} AS sentiment FROM (SELECT {_scored('text', *CHECK_WORDS)} AS x FROM documents)) "
                       f"GROUP BY ALL",
    "roster_load": f"WITH {_roster_base()} SELECT * FROM roster",
    "roster_dedup": f"WITH {_roster_base()} SELECT * FROM dedup",
    "roster_file_order": "WITH l AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment || ' ' || v AS party, "
                         "md5(CAST(c_custkey AS VARCHAR) || ':' || v) AS o, "
                         "row_number() OVER (PARTITION BY c_custkey % 3 ORDER BY md5(CAST(c_custkey AS VARCHAR) || ':' || v)) AS line "
                         "FROM customer, (SELECT unnest(['0', '1', '2']) AS v)) "
                         "SELECT user_id, party, line FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY o DESC) AS rn FROM l) WHERE rn = 1",
    "roster_rules": f"WITH {_roster_base()}, pos AS (SELECT user_id, screen_name, "
                    f"CAST((row_number() OVER (ORDER BY user_id, screen_name) - 1) // 20 + 1 AS INTEGER) AS chunk, "
                    f"row_number() OVER (ORDER BY user_id, screen_name) AS rn FROM dedup) "
                    f"SELECT chunk, 'MdBList' || CAST(chunk AS VARCHAR) AS tag, CAST(count(*) AS INTEGER) AS n_accounts, "
                    f"'{{ \"add\": [ {{ \"value\": \"' || string_agg('from:' || screen_name, ' OR ' ORDER BY rn) || "
                    f"' lang:de -is:retweet\",\"tag\": \"MdBList' || CAST(chunk AS VARCHAR) || '\"}}]}}' AS rule "
                    f"FROM pos GROUP BY chunk",
    "replay_unwrap": _q("SELECT id, party FROM posts"),
    "ingest_counts": _q(f"SELECT count(*) AS lines, count(*) FILTER (WHERE NOT {_BAD}) AS valid, "
                        f"count(*) FILTER (WHERE {_BAD}) AS rejected, "
                        f"count(*) FILTER (WHERE event_id % {TB.TRUNCATED_MOD} <> 0 AND event_id % {TB.ERROR_MOD} = 0) "
                        f"AS error_envelopes FROM base"),
    "stream_progress": _q(f"SELECT count(*) AS lines, count(*) FILTER (WHERE NOT {_BAD}) AS valid, count(*) FILTER (WHERE {_BAD}) AS rejected, "
                          f"count(*) FILTER (WHERE event_id % {TB.TRUNCATED_MOD} <> 0 AND event_id % {TB.ERROR_MOD} = 0) AS error_envelopes, "
                          f"CAST(0 AS BIGINT) AS dropped, CAST(0 AS BIGINT) AS failed FROM base"),
    "stream_state_audit": _q(f"SELECT {H}, party, count(*) AS in_state, count(*) AS in_table FROM hposts GROUP BY ALL"),
    "metric_from_sql": _q(f"SELECT {H}, party, source, CAST(count(*) AS BIGINT) AS posts, CAST(count(DISTINCT username) AS BIGINT) AS users, "
                          f"round(avg(CASE WHEN {_SENT} >= 0 THEN {_SENT} END), 9) AS mean_sentiment FROM hposts p JOIN docsent s USING (doc_id) GROUP BY ALL"),
    "raw_landing": _q("SELECT id, id AS landed_id, user_id AS landed_author_id FROM posts"),
    # Days before the newer run keep the older run's counts, which are twice the true ones.
    "upsert_merge": _q(f"SELECT {H}, party, CAST(c * (CASE WHEN day < 15 THEN 2 ELSE 1 END) AS BIGINT) AS count "
                       f"FROM (SELECT {H}, party, count(*) AS c FROM hposts GROUP BY ALL)"),
    "last15_documents": _q("SELECT scope, party, array_to_string(list(id ORDER BY ts_ms, id), ',') AS tweet_ids FROM ("
                           "SELECT 'party' AS scope, party, id, ts_ms, row_number() OVER (PARTITION BY party ORDER BY ts_ms DESC, id DESC) AS rn FROM posts "
                           "UNION ALL SELECT 'combined', NULL, id, ts_ms, row_number() OVER (ORDER BY ts_ms DESC, id DESC) FROM posts) "
                           "WHERE rn <= 15 GROUP BY scope, party"),
    "metric_documents": _q(f"SELECT '{{\"_id\":{{\"year\":' || year || ',\"month\":' || month || ',\"day\":' || day || ',\"hour\":' || hour || "
                           f"',\"party\":\"' || party || '\"}},\"count\":' || c || '}}' AS document FROM "
                           f"(SELECT {H}, party, count(*) AS c FROM hposts GROUP BY {H}, party)"),
    "stream_late_posts": _q(f"SELECT {H}, party, count(*) AS count FROM hposts GROUP BY ALL"),
    "stream_late_corrections": _q(f"SELECT {H}, party, count(*) AS count FROM hposts GROUP BY ALL"),
    "stream_last15_combined": _q("SELECT CAST(row_number() OVER (ORDER BY ts_ms DESC, id DESC) AS INTEGER) AS recency, id "
                                 "FROM posts ORDER BY ts_ms DESC, id DESC LIMIT 15"),
    "stream_ingest": _q("SELECT id, party, createdDate, user_id, attachments FROM posts"),
    "stream_posts_by_hour": _q(f"SELECT {H}, party, count(*) AS count FROM hposts GROUP BY ALL"),
    "stream_hashtags_by_hour": _q(f"SELECT {H}, hashtag, count(*) AS count FROM "
                                  f"(SELECT {H}, unnest(hashtags) AS hashtag FROM hposts) GROUP BY ALL"),
    "stream_hashtags_by_hour_party": _q(f"SELECT {H}, hashtag, party, count(*) AS count FROM "
                                        f"(SELECT {H}, party, unnest(hashtags) AS hashtag FROM hposts) GROUP BY ALL"),
    "stream_media_by_kind_hour": _q(f"SELECT {H}, attachments, party, count(*) AS count FROM hposts "
                                    f"WHERE attachments <> 0 GROUP BY ALL"),
    "stream_source_by_hour": _q(f"SELECT {H}, party, source, count(*) AS count FROM hposts GROUP BY ALL"),
    "stream_media_by_hour": _q(f"SELECT {H}, party, CAST(sum(attachments) AS BIGINT) AS count FROM hposts "
                               f"WHERE attachments <> 0 GROUP BY ALL"),
    "stream_active_users_by_hour": _q(f"SELECT {H}, username, party, count(*) AS count FROM hposts GROUP BY ALL"),
    "stream_sentiment_by_hour": _q(f"SELECT {H}, party, round(avg({_SENT}), 9) AS sentiment "
                                   f"FROM hposts p JOIN docsent s USING (doc_id) GROUP BY ALL"),
    "stream_last15_state": _q(_LAST15_BY_PARTY),
    "stream_last15": _q(_LAST15_BY_PARTY),
}
