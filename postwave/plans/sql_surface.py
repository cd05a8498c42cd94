"""The library as SQL (§2.7): functions and table functions that Catalyst inlines, so a metric can be declared in SQL text alone.

``register`` makes temporary SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN``) over a posts view. Their bodies are plain SQL: the optimizer puts them in
place of the call, so pushdown, pruning and partial aggregation work as in the DataFrame form, and no Python runs.

    register(spark, posts)
    spark.sql("SELECT hour_start, party, count(*) FROM hourly_posts('2024-01-01', '2024-01-31') GROUP BY ALL")

=====================  =============================================================================
``utc_hour(ts)``       start of the UTC hour, whatever the session zone
``utc_parts(ts)``      struct of year, month, day, hour (UTC): the metrics' key
``scored(x)``          a sentiment, or null for the -1 of texts without a sentence
``sentiment_name(x)``  label of a score on the 0..4 scale
``hourly_posts(a, b)`` posts of the UTC dates from a to b with ``hour_start`` and the key's parts (table function)
``hourly_tags(a, b)``  the same, one row per hashtag
=====================  =============================================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POSTS_VIEW = "postwave_posts"

_SECONDS = "unix_seconds(ts)"
_DAY = f"date_from_unix_date(CAST(floor({_SECONDS} / 86400) AS INT))"

FUNCTIONS = {
    "utc_hour(ts TIMESTAMP)": ("TIMESTAMP", f"timestamp_seconds({_SECONDS} - pmod({_SECONDS}, 3600))"),
    "utc_parts(ts TIMESTAMP)": ("STRUCT<year: INT, month: INT, day: INT, hour: INT>",
                                f"named_struct('year', year({_DAY}), 'month', month({_DAY}), 'day', day({_DAY}), 'hour', CAST(pmod(floor({_SECONDS} / 3600), 24) AS INT))"),
    "scored(x DOUBLE)": ("DOUBLE", "CASE WHEN x >= 0 THEN x END"),
    "sentiment_name(x DOUBLE)": ("STRING", "CASE WHEN x <= 0 OR x >= 5 OR x IS NULL THEN 'not_understood' WHEN x < 1 THEN 'very_negative' WHEN x < 2 THEN 'negative' "
                                           "WHEN x < 3 THEN 'neutral' WHEN x < 4 THEN 'positive' ELSE 'very_positive' END"),
}
_KEY = "utc_hour(created_ts) AS hour_start, utc_parts(created_ts).year AS year, utc_parts(created_ts).month AS month, utc_parts(created_ts).day AS day, utc_parts(created_ts).hour AS hour"
_BETWEEN = "unix_seconds(created_ts) >= unix_date(from_date) * 86400L AND unix_seconds(created_ts) < (unix_date(to_date) + 1) * 86400L"
TABLE_FUNCTIONS = {
    "hourly_posts(from_date DATE, to_date DATE)": (
        "hour_start TIMESTAMP, year INT, month INT, day INT, hour INT, id STRING, party STRING, username STRING, source STRING, attachments INT, sentiment DOUBLE, hashtags ARRAY<STRING>",
        f"SELECT {_KEY}, id, party, username, source, attachments, sentiment, hashtags FROM {POSTS_VIEW} WHERE {_BETWEEN}"),
    "hourly_tags(from_date DATE, to_date DATE)": (
        "hour_start TIMESTAMP, year INT, month INT, day INT, hour INT, id STRING, party STRING, hashtag STRING",
        f"SELECT {_KEY}, id, party, tag FROM {POSTS_VIEW} LATERAL VIEW explode(hashtags) t AS tag WHERE {_BETWEEN}"),
}


def register(spark: SparkSession, posts: DataFrame, view: str = POSTS_VIEW) -> None:
    """Makes the view of ``posts`` and the functions over it, for this session."""
    posts.createOrReplaceTempView(view)
    for head, (returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {returns} RETURN {body}")
    for head, (columns, body) in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS TABLE({columns}) RETURN {body.replace(POSTS_VIEW, view)}")
