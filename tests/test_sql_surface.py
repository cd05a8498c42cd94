"""Metrics declared in SQL text equal the specs, in any session zone, and stay plain plans."""

import datetime as dt

from pyspark.sql import functions as F

from postwave.functions import sentiment as S
from postwave.operators import metrics as M
from postwave.plans import sql_surface

POSTS = "id string, party string, username string, source string, attachments int, sentiment double, hashtags array<string>, created_ts timestamp"


def some_posts(spark):
    t = lambda h, m=0: dt.datetime(2024, 3, 31, h, m, tzinfo=dt.timezone.utc)
    return spark.createDataFrame([("1", "p", "u", "app", 0, 1.5, ["a", "b"], t(0)), ("2", "p", "v", "app", 2, -1.0, [], t(0, 59)), ("3", "q", "u", "web", 0, 3.5, ["a"], t(23)),
                                  ("4", "q", "u", "web", 0, 0.0, None, t(23, 59) + dt.timedelta(minutes=1))], POSTS)


def test_sql_metrics_equal_specs(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Asia/Kolkata", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            posts = some_posts(spark)
            sql_surface.register(spark, posts)
            cols = "year, month, day, hour, party"
            got = spark.sql(f"SELECT {cols}, count(*) AS count FROM hourly_posts('2024-03-31', '2024-04-01') GROUP BY ALL")
            assert sorted(got.collect()) == sorted(M.metric_from_spec(posts, M.POSTS_BY_HOUR_PARTY).collect())
            got = spark.sql(f"SELECT {cols.replace('party', 'hashtag')}, count(*) AS count FROM hourly_tags('2024-03-31', '2024-04-01') GROUP BY ALL")
            assert sorted(got.collect()) == sorted(M.metric_from_spec(posts, M.HASHTAGS_BY_HOUR).collect())
            assert [r[0] for r in spark.sql("SELECT id FROM hourly_posts('2024-04-01', '2024-04-01')").collect()] == ["4"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_labels_equal_the_expression(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 0.5, 1.0, 2.0, 2.9, 3.0, 4.0, 4.9, 5.0, None)], "x double")
    sql_surface.register(spark, some_posts(spark))
    df.createOrReplaceTempView("scores")
    got = spark.sql("SELECT x, sentiment_name(x) AS l FROM scores").collect()
    want = df.select("x", S.sentiment_label(F.col("x")).alias("l")).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_functions_are_inlined_and_filters_pushed(spark, tmp_dir):
    some_posts(spark).write.parquet(f"{tmp_dir}/posts")
    sql_surface.register(spark, spark.read.parquet(f"{tmp_dir}/posts"), "stored_posts")
    plan = spark.sql("SELECT hour, count(*) FROM hourly_posts('2024-03-31', '2024-03-31') WHERE party = 'p' GROUP BY hour")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "EqualTo(party,p)" in plan
    assert "hashtags" not in plan and "sentiment" not in plan
