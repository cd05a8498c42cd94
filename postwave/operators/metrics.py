"""Hourly metrics declared as specs (A1-A7) and built by one function, batch or streaming.

A spec names an optional filter, an optional column to explode, the group keys and the measure.
``metric_from_spec`` turns it into ``groupBy(window(ts, size), *keys).agg(measure)`` and then the
hour key (year, month, day, hour in UTC) of the window start. Counts, sums and averages are
partial aggregates: each task combines its rows before the shuffle, so a hot key (one party with
a third of all posts) costs one row per task, not one per post.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwave.functions.timekeys import hour_key


@dataclass(frozen=True)
class MetricSpec:
    name: str
    keys: tuple[str, ...]
    measure: str = "count"            # "count", "sum:<col>", "avg:<col>", "avg_scored:<col>"
    measure_name: str = "count"
    where: str | None = None
    explode: tuple[str, str] | None = None   # (array column, element name)
    window: str = "1 hour"
    trigger: str = "1 minute"         # processing-time trigger of the streaming form


def _measure(spec: MetricSpec) -> Column:
    if spec.measure == "count":
        return F.count(F.lit(1)).alias(spec.measure_name)
    kind, col = spec.measure.split(":", 1)
    if kind == "avg":
        return F.avg(F.col(col)).alias(spec.measure_name)
    if kind == "sum":
        return F.sum(F.col(col)).alias(spec.measure_name)
    if kind == "avg_scored":
        # mean over the scored values (>= 0); -1 when the group has none
        return F.coalesce(F.avg(F.when(F.col(col) >= 0, F.col(col))), F.lit(-1.0)).alias(spec.measure_name)
    raise ValueError(f"unknown measure {spec.measure}")


def windowed(posts: DataFrame, spec: MetricSpec, time_col: str = "created_ts") -> DataFrame:
    """The grouped frame with the ``window`` struct kept (the streaming form needs it)."""
    return _grouped(posts, spec, time_col).agg(_measure(spec))


def windowed_partials(posts: DataFrame, spec: MetricSpec, time_col: str = "created_ts") -> DataFrame:
    """Like ``windowed``, with the measure's sums, ``_rows`` and ``_latest`` (the greatest time, in microseconds)."""
    return _grouped(posts, spec, time_col).agg(*partials(spec), F.count(F.lit(1)).alias("_rows"), F.max(F.unix_micros(F.col(time_col))).alias("_latest"))


def _grouped(posts: DataFrame, spec: MetricSpec, time_col: str):
    df = posts
    if spec.where:
        df = df.where(spec.where)
    if spec.explode:
        arr, elem = spec.explode
        df = df.withColumn(elem, F.explode(F.col(arr)))
    return df.groupBy(F.window(F.col(time_col), spec.window).alias("window"), *spec.keys)


def partials(spec: MetricSpec) -> list[Column]:
    """The measure as sums that can be added up over batches (see ``from_partials``)."""
    if spec.measure == "count":
        return [F.count(F.lit(1)).alias("_n")]
    kind, col = spec.measure.split(":", 1)
    value = F.when(F.col(col) >= 0, F.col(col)) if kind == "avg_scored" else F.col(col)
    return [F.sum(value).alias("_s")] if kind == "sum" else [F.sum(value).alias("_s"), F.count(value).alias("_n")]


def partial_columns(spec: MetricSpec) -> list[str]:
    return ["_n"] if spec.measure == "count" else ["_s"] if spec.measure.startswith("sum:") else ["_s", "_n"]


def from_partials(spec: MetricSpec) -> Column:
    """The measure from its added-up sums."""
    if spec.measure == "count":
        value = F.col("_n")
    elif spec.measure.startswith("sum:"):
        value = F.col("_s")
    else:
        value = F.when(F.col("_n") > 0, F.col("_s") / F.col("_n"))
        value = F.coalesce(value, F.lit(-1.0)) if spec.measure.startswith("avg_scored:") else value
    return value.alias(spec.measure_name)


def with_hour_key(df: DataFrame, spec: MetricSpec) -> DataFrame:
    return df.select(*hour_key(F.col("window.start")), *spec.keys, spec.measure_name)


def metric_from_spec(posts: DataFrame, spec: MetricSpec, time_col: str = "created_ts") -> DataFrame:
    return with_hour_key(windowed(posts, spec, time_col), spec)


# The seven hourly metrics of the reference. Triggers are the reference's refresh intervals.
HASHTAGS_BY_HOUR = MetricSpec("hashtags_by_hour", ("hashtag",), explode=("hashtags", "hashtag"))
HASHTAGS_BY_HOUR_PARTY = MetricSpec("hashtags_by_hour_party", ("hashtag", "party"),
                                    explode=("hashtags", "hashtag"))
POSTS_BY_HOUR_PARTY = MetricSpec("posts_by_hour_party", ("party",))
MEDIA_BY_KIND_HOUR_PARTY = MetricSpec("media_by_kind_hour_party", ("attachments", "party"),
                                      where="attachments != 0", trigger="5 minutes")
# A4 stage 2 in one aggregate: sum over posts of their kinds = sum over kinds of count x kinds
MEDIA_BY_HOUR_PARTY = MetricSpec("media_by_hour_party", ("party",), measure="sum:attachments",
                                 where="attachments != 0", trigger="5 minutes")
ACTIVE_USERS_BY_HOUR_PARTY = MetricSpec("active_users_by_hour_party", ("username", "party"), trigger="5 minutes")
SENTIMENT_BY_HOUR_PARTY = MetricSpec("sentiment_by_hour_party", ("party",), measure="avg:sentiment",
                                     measure_name="sentiment", trigger="5 minutes")
SCORED_SENTIMENT_BY_HOUR_PARTY = MetricSpec("scored_sentiment_by_hour_party", ("party",),
                                            measure="avg_scored:sentiment", measure_name="sentiment",
                                            trigger="5 minutes")
SOURCE_BY_HOUR_PARTY = MetricSpec("source_by_hour_party", ("party", "source"), trigger="5 minutes")

STANDARD_SPECS = (HASHTAGS_BY_HOUR, HASHTAGS_BY_HOUR_PARTY, POSTS_BY_HOUR_PARTY, MEDIA_BY_KIND_HOUR_PARTY,
                  ACTIVE_USERS_BY_HOUR_PARTY, SENTIMENT_BY_HOUR_PARTY, SOURCE_BY_HOUR_PARTY)
# what the streaming application keeps: the seven, plus A4's per-(hour, party) value
APP_SPECS = STANDARD_SPECS + (MEDIA_BY_HOUR_PARTY,)


def as_documents(metric: DataFrame, spec: MetricSpec, as_json: bool = False) -> DataFrame:
    """The stored-document shape of a metric row: ``_id`` = {year, month, day, hour, *keys} plus the
    measure (what a document-store writer in ``foreachBatch`` would send, replacing by ``_id``)."""
    key = F.struct(*[F.col(c) for c in ("year", "month", "day", "hour", *spec.keys)]).alias("_id")
    docs = metric.select(key, F.col(spec.measure_name))
    if as_json:
        return docs.select(F.to_json(F.struct("_id", spec.measure_name)).alias("document"))
    return docs


def media_by_hour_party(per_kind: DataFrame) -> DataFrame:
    """A4 stage 2: attachment kinds used per hour and party = sum(count * attachments).

    The reference keyed this by (hour, party) only, so rows for different kinds overwrote each
    other; the sum over kinds is the value that key should hold.
    """
    return (per_kind.groupBy("year", "month", "day", "hour", "party")
            .agg(F.sum(F.col("count") * F.col("attachments")).cast("bigint").alias("count")))


def sentiment_by_hour_party(posts: DataFrame, include_unscored: bool = True,
                            time_col: str = "created_ts") -> DataFrame:
    """A6. ``include_unscored`` keeps the -1 of texts with no sentence in the mean, as the
    reference did; without it they are left out and an hour holding only such posts shows -1.
    Either way one aggregate over the posts."""
    spec = SENTIMENT_BY_HOUR_PARTY if include_unscored else SCORED_SENTIMENT_BY_HOUR_PARTY
    return metric_from_spec(posts, spec, time_col)
