"""Input shapes of the field table in FIXTURES.md."""

import json

from postwave.operators import parse
from postwave.sources.envelopes import replay_envelopes
from tests.envelopes import envelope, user


def parse_one(spark, line):
    df = spark.createDataFrame([(line,)], "value string")
    parsed = parse.parse_lines(df)
    posts = parse.posts(parsed).collect()
    return (posts[0] if posts else None), parsed.collect()[0]["reject_reason"]


def test_only_hashtags_of_the_entities_are_read(spark):
    """Mentions, urls and annotations are ignored, whatever they hold."""
    for members in ({"mentions": [{"start": 3, "end": 9, "username": "nobody"}]}, {"urls": [{"url": "https://example.org/a"}]},
                    {"annotations": [{"type": "Place", "probability": 0.25}], "urls": []}):
        p, r = parse_one(spark, envelope(pid="61", entities=members))
        assert r is None and p["hashtags"] == []
        p, r = parse_one(spark, envelope(pid="62", entities={**members, "hashtags": [{"tag": "eins"}, {"start": 1, "end": 5, "tag": "zwei"}]}))
        assert r is None and p["hashtags"] == ["eins", "zwei"]


def test_posts_without_entities_or_with_a_reply_id(spark):
    p, r = parse_one(spark, envelope(pid="63"))
    assert r is None and p["hashtags"] == [] and p["attachments"] == 0 and p["in_reply_to_user_id"] == ""
    p, r = parse_one(spark, envelope(pid="64", author="3", users=[user("4"), user("3", "third")], extra_data={"in_reply_to_user_id": "4"}))
    assert r is None and p["in_reply_to_user_id"] == "4" and p["username"] == "third" and len(p["users"]) == 2


def test_each_required_field_is_required(spark):
    for key in ("id", "text", "created_at", "source"):
        p, r = parse_one(spark, envelope(drop=(key,)))
        assert p is None and r == "missing_required_field"


def test_replay_file_shapes(spark):
    post = envelope(pid="502", entities={"hashtags": [{"tag": "eins"}]})
    err = json.dumps({"errors": [{"title": "operational-disconnect", "disconnect_type": "Upstream",
                                  "detail": "gone", "type": "about:blank"}]})
    lines = [
        json.dumps({"_id": {"$oid": "a1"}, "id": "502", "tweet": post}),
        json.dumps({"_id": {"$oid": "a2"}, "id": "503", "tweet": err}),
        "",
        "",
        err[: len(err) // 2],
        json.dumps({"_id": {"$oid": "a3"}, "id": "504", "tweet": {"not": "a string"}}),
        json.dumps({"_id": {"$oid": "a4"}, "id": "505"}),
    ]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "n int, value string")
    env = replay_envelopes(df)
    got = {r["n"]: r["value"] for r in env.collect()}
    assert got == {0: post, 1: err, 5: "", 6: ""}          # blank and broken lines are skipped
    parsed = parse.parse_lines(env)
    reasons = {r["n"]: r["reject_reason"] for r in parsed.collect()}
    assert reasons == {0: None, 1: "error_envelope", 5: "malformed_json", 6: "malformed_json"}
