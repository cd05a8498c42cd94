import datetime as dt

from pyspark.sql import functions as F

from postwave.operators import metrics as M

UTC = dt.timezone.utc


def posts(spark, rows):
    schema = ("id string, party string, username string, source string, hashtags array<string>, "
              "attachments int, sentiment double, created_ts timestamp")
    return spark.createDataFrame(rows, schema)


def ts(h, m=0, s=0, ms=0):
    return dt.datetime(2024, 3, 31, h, m, s, ms * 1000, tzinfo=UTC)


def test_hour_buckets_and_keys(spark):
    df = posts(spark, [
        ("1", "a", "u1", "web", ["x", "y", "x"], 0, 2.0, ts(0, 59, 59, 999)),
        ("2", "a", "u1", "web", [], 1, 3.0, ts(1, 0, 0, 0)),
        ("3", "b", "u2", "app", ["x"], 2, -1.0, ts(1, 30)),
    ])
    a3 = {tuple(r) for r in M.metric_from_spec(df, M.POSTS_BY_HOUR_PARTY).collect()}
    assert a3 == {(2024, 3, 31, 0, "a", 1), (2024, 3, 31, 1, "a", 1), (2024, 3, 31, 1, "b", 1)}
    a1 = {tuple(r) for r in M.metric_from_spec(df, M.HASHTAGS_BY_HOUR).collect()}
    assert a1 == {(2024, 3, 31, 0, "x", 2), (2024, 3, 31, 0, "y", 1), (2024, 3, 31, 1, "x", 1)}
    media = M.metric_from_spec(df, M.MEDIA_BY_KIND_HOUR_PARTY)
    assert {tuple(r) for r in media.collect()} == {(2024, 3, 31, 1, 1, "a", 1), (2024, 3, 31, 1, 2, "b", 1)}
    assert {tuple(r) for r in M.media_by_hour_party(media).collect()} == {(2024, 3, 31, 1, "a", 1),
                                                                         (2024, 3, 31, 1, "b", 2)}
    a6 = {tuple(r) for r in M.sentiment_by_hour_party(df).collect()}
    assert a6 == {(2024, 3, 31, 0, "a", 2.0), (2024, 3, 31, 1, "a", 3.0), (2024, 3, 31, 1, "b", -1.0)}
    a6x = {tuple(r) for r in M.sentiment_by_hour_party(df, include_unscored=False).collect()}
    assert (2024, 3, 31, 1, "b", -1.0) in a6x and len(a6x) == 3


def test_hour_key_is_utc_whatever_the_session_zone(spark):
    df = posts(spark, [("1", "a", "u", "s", [], 0, 0.0, ts(1, 30))])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        row = M.metric_from_spec(df, M.POSTS_BY_HOUR_PARTY).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (row["year"], row["month"], row["day"], row["hour"]) == (2024, 3, 31, 1)


def test_counts_are_partial_aggregates(spark):
    df = posts(spark, [("1", "a", "u", "s", ["x"], 1, 0.0, ts(1))])
    plan = M.metric_from_spec(df, M.HASHTAGS_BY_HOUR_PARTY)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_spec_filter_is_pushed_to_parquet(spark, tmp_dir):
    df = posts(spark, [("1", "a", "u", "s", ["x"], 1, 0.0, ts(1)), ("2", "a", "u", "s", [], 0, 0.0, ts(2))])
    df.write.parquet(f"{tmp_dir}/posts")
    q = M.metric_from_spec(spark.read.parquet(f"{tmp_dir}/posts"), M.MEDIA_BY_KIND_HOUR_PARTY)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(attachments), Not(EqualTo(attachments,0))" in plan
    assert "ReadSchema: struct<party:string,attachments:int,created_ts:timestamp>" in plan
    assert q.count() == 1


def test_iso_text_is_zone_free(spark):
    from postwave.functions.timekeys import iso_millis_utc
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.123456' t union all "
                       "select timestamp_ntz'2024-01-01 00:00:07' t")
        got = sorted(r[0] for r in df.select(iso_millis_utc(F.col("t"))).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2024-01-01T00:00:07.000Z", "2024-03-10T02:30:00.123Z"]


def test_created_at_without_zone_is_utc(spark):
    from postwave.functions.timekeys import hour_key, parse_created_at
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = spark.createDataFrame([("2024-03-07T08:15:30",), ("2024-03-07T08:15:30.000Z",),
                                    ("2024-03-07T10:15:30+02:00",), ("garbage",)], "c string")
        got = [tuple(r) for r in df.select(*hour_key(parse_created_at(F.col("c")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got[:3] == [(2024, 3, 7, 8)] * 3 and got[3] == (None, None, None, None)


def test_media_stage_two_as_one_aggregate(spark):
    df = posts(spark, [("1", "a", "u", "s", [], 2, 0.0, ts(1)), ("2", "a", "u", "s", [], 2, 0.0, ts(1, 10)),
                       ("3", "a", "u", "s", [], 1, 0.0, ts(1, 20)), ("4", "b", "u", "s", [], 0, 0.0, ts(1))])
    two_stage = M.media_by_hour_party(M.metric_from_spec(df, M.MEDIA_BY_KIND_HOUR_PARTY))
    one = M.metric_from_spec(df, M.MEDIA_BY_HOUR_PARTY)
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in two_stage.collect()} == {(2024, 3, 31, 1, "a", 5)}
    assert dict(one.dtypes)["count"] == "bigint"


def test_as_documents(spark):
    df = posts(spark, [("1", "a", "u1", "web", ["x"], 0, 2.0, ts(5))])
    doc = M.as_documents(M.metric_from_spec(df, M.HASHTAGS_BY_HOUR_PARTY), M.HASHTAGS_BY_HOUR_PARTY, as_json=True)
    assert doc.collect()[0]["document"] == ('{"_id":{"year":2024,"month":3,"day":31,"hour":5,"hashtag":"x",'
                                           '"party":"a"},"count":1}')
