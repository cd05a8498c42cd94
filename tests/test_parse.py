import json

import pytest
from pyspark.sql import functions as F

from postwave.operators import parse
from tests.envelopes import envelope, user


def run(spark, lines):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "n int, value string")
    parsed = parse.parse_lines(df)
    posts = {r["id"]: r for r in parse.posts(parsed).collect()}
    reasons = [r["reject_reason"] for r in parsed.orderBy("n").collect()]
    return posts, reasons


def one(spark, line):
    posts, reasons = run(spark, [line])
    return (list(posts.values())[0] if posts else None), reasons[0]


def test_valid_post_columns(spark):
    p, reason = one(spark, envelope(pid="7", author="10", users=[user("9"), user("10", "alice", "Alice")],
                                   rules=[{"id": 1, "tag": "a"}, {"id": 2}, {"id": 3, "tag": "b"}],
                                   entities={"hashtags": [{"start": 0, "end": 3, "tag": "x"},
                                                          {"start": 4, "end": 5, "tag": ""}, {"start": 6},
                                                          {"tag": None}, {"tag": "x"}]},
                                   attachments={"media_keys": ["m"], "poll_ids": ["p"]}))
    assert reason is None
    assert p["id"] == "7" and p["user_id"] == "10"
    assert (p["username"], p["name"]) == ("alice", "Alice")         # author looked up among users
    assert [u["user_id"] for u in p["users"]] == ["9", "10"]        # all users kept in order
    assert p["party"] == "b"                                        # last rule carrying a tag
    assert p["hashtags"] == ["x", "x"]                              # empty, missing, null dropped; dups kept
    assert p["attachments"] == 2                                    # number of kinds, not of media
    assert p["in_reply_to_user_id"] == ""                           # default
    assert p["createdDate"] == "2024-03-07T08:15:30.250Z"
    assert str(p["created_ts"]) .startswith("2024-03-07 08:15:30")
    assert json.loads(p["json"])["data"]["id"] == "7"


def test_defaults_and_no_tag(spark):
    p, reason = one(spark, envelope(rules=[{"id": 1}], extra_data={"in_reply_to_user_id": "55"}))
    assert reason is None and p["party"] == "" and p["in_reply_to_user_id"] == "55"
    p, _ = one(spark, envelope(rules=[]))
    assert p["party"] == "" and p["hashtags"] == [] and p["attachments"] == 0


@pytest.mark.parametrize("line,reason", [
    ("", "malformed_json"),
    ('{"data": {"id": "1"', "malformed_json"),
    ("{}", "malformed_json"),
    (json.dumps({"includes": {"users": []}, "matching_rules": []}), "missing_data"),
    (envelope(users=None, includes=None), "missing_users"),
    (envelope(drop=("source",)), "missing_required_field"),
    (envelope(drop=("text",)), "missing_required_field"),
    (envelope(extra_data={"id": None}), "missing_required_field"),
    (envelope(extra_data={"entities": None}), "bad_entities"),
    (envelope(extra_data={"attachments": None}), "bad_attachments"),
    (envelope(rules=[{"id": 1, "tag": None}]), "null_rule_tag"),
    (envelope(users=[{"id": "10", "name": "x"}]), "incomplete_user"),
    (envelope(author="10", users=[user("11")]), "author_not_in_users"),
    (envelope(drop=("source",), errors=[{"title": "Not Found Error"}]), "missing_required_field"),
    (envelope(users=[user("99")], errors=[{"title": "x"}]), "error_envelope"),
    (envelope(created="yesterday"), "bad_created_at"),
])
def test_reject_reasons(spark, line, reason):
    if '"includes": null' in line:
        env = json.loads(line)
        env.pop("includes")
        line = json.dumps(env)
    p, got = one(spark, line)
    assert p is None and got == reason


def test_error_envelopes(spark):
    errs = [json.dumps({"errors": [{"title": "operational-disconnect", "type": "x"}]}),
            json.dumps({"errors": [{"title": "operational-disconnect"}, {"title": "other"}]}),
            json.dumps({"errors": [{"detail": "no title"}]})]
    df = spark.createDataFrame([(l,) for l in errs], "value string")
    rows = parse.rejects(parse.parse_lines(df)).select("reason", "error_title", "error_action").collect()
    assert sorted(tuple(r) for r in rows) == sorted([
        ("error_envelope", "operational-disconnect", "stop"),
        ("error_envelope", "other", "reconnect"),        # last title wins
        ("error_envelope", "", "reconnect")])


def test_post_wins_over_errors_key(spark):
    p, reason = one(spark, envelope(errors=[{"title": "operational-disconnect"}]))
    assert reason is None and p is not None


def test_numeric_id_is_coerced(spark):
    env = json.loads(envelope())
    env["data"]["id"] = 123
    p, reason = one(spark, json.dumps(env))
    assert reason is None and p["id"] == "123"


def test_document_roundtrip(spark):
    df = spark.createDataFrame([(envelope(pid="5", entities={"hashtags": [{"tag": "h"}]}),)], "value string")
    docs = parse.post_document(parse.parse_posts(df))
    assert "json" not in docs.columns
    back = parse.from_document_json(parse.to_document_json(docs)).collect()[0]
    assert back["id"] == "5" and back["hashtags"] == ["h"] and back["users"][0]["id"] == "10"


def test_each_line_parsed_once(spark):
    df = spark.createDataFrame([(envelope(),)], "value string")
    plan = parse.posts(parse.parse_lines(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(data") == 1


@pytest.mark.parametrize("ents,reason", [
    ({"hashtags": None}, "bad_entities"),
    ({"hashtags": "x"}, "bad_entities"),
    ({"hashtags": [{"tag": "a"}, 5]}, "bad_entities"),
    ({"mentions": []}, None),
    ({"hashtags": []}, None),
])
def test_entities_shapes(spark, ents, reason):
    p, got = one(spark, envelope(entities=ents))
    assert got == reason


def test_keep_null_tags(spark):
    df = spark.createDataFrame([(envelope(entities={"hashtags": [{"tag": None}, {"start": 1}, {"tag": "a"}]}),)],
                               "value string")
    p = parse.posts(parse.parse_lines(df), keep_null_tags=True).collect()[0]
    assert p["hashtags"] == [None, "a"]          # null kept, missing tag dropped as empty


def test_strict_mode_rejects_non_string_fields(spark):
    env = json.loads(envelope(entities={"hashtags": [{"tag": "h"}]}, attachments={"media_keys": ["m"]}))
    env["data"]["id"] = 123
    numeric = json.dumps(env)
    reply = json.loads(envelope())
    reply["data"]["in_reply_to_user_id"] = 5
    good = envelope(entities={"hashtags": [{"tag": "h"}]}, attachments={"media_keys": ["m"]},
                    extra_data={"in_reply_to_user_id": None})
    df = spark.createDataFrame([(0, numeric), (1, json.dumps(reply)), (2, good)], "n int, value string")
    strict = {r["n"]: r["reject_reason"] for r in parse.parse_lines(df, strict=True).collect()}
    lenient = {r["n"]: r["reject_reason"] for r in parse.parse_lines(df).collect()}
    assert strict == {0: "non_string_field", 1: "non_string_field", 2: None}
    assert lenient == {0: None, 1: None, 2: None}
    p = parse.posts(parse.parse_lines(df.where("n = 2"), strict=True)).collect()[0]
    assert p["hashtags"] == ["h"] and p["attachments"] == 1 and p["in_reply_to_user_id"] is None


def test_times_without_zone_are_utc_in_any_session_zone(spark):
    from postwave.functions.timekeys import parse_created_at
    cases = {"2024-01-01": 1704067200, "2024-01": 1704067200, "2024": 1704067200, "2024-01-01T00:00:00": 1704067200, "2024-01-01 00:00:00": 1704067200,
             "2024-01-01T00:00:00Z": 1704067200, "2024-01-01T02:00:00+02:00": 1704067200, "2024-01-01T00:00:00.000-01": 1704070800,
             "2024-01-01 09:00:00 +09:00": 1704067200, " 2024-01-01 ": 1704067200, "2024-13-01": None, "10.30 Uhr": None, "": None}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Asia/Tokyo", "America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(c,) for c in cases], "c string").select("c", F.unix_seconds(parse_created_at(F.col("c"))).alias("s"))
            assert {r["c"]: r["s"] for r in df.collect()} == cases
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_raw_landing_is_shredded_and_fields_are_read_alone(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    lines = spark.createDataFrame([(envelope(pid=str(i), author=str(100 + i), text="words " * 50),) for i in range(300)], "value string")
    parse.write_raw_landing(parse.posts(parse.parse_lines(lines)), f"{tmp_dir}/raw")
    names = {pq.ParquetFile(f).schema.column(k).path for f in glob.glob(f"{tmp_dir}/raw/*.parquet") for k in range(len(pq.ParquetFile(f).schema))}
    assert any(n.startswith("parsed.typed_value.data.typed_value.author_id.") for n in names)
    read = spark.read.parquet(f"{tmp_dir}/raw").select("id", F.variant_get("parsed", "$.data.author_id", "string").alias("author"))
    assert {(r["id"], r["author"]) for r in read.collect()} == {(str(i), str(100 + i)) for i in range(300)}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "parsed:struct<0:string>" in plan and "parsed:variant" not in plan and "json" not in plan
