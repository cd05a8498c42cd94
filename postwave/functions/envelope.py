"""Column expressions over a parsed post envelope.

Every function here returns a ``Column``; nothing runs in Python per row. The envelope is parsed
once with ``from_json`` into ``ENVELOPE_SCHEMA``. ``data`` and the user objects are kept as
``map<string,string>`` so that an absent key and an explicit JSON ``null`` stay distinguishable
(the validity rule treats them differently); nested objects arrive as their raw JSON text and are
parsed again only where needed (entities, attachments), which touches a small substring.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

STR_MAP = T.MapType(T.StringType(), T.StringType())

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("data", STR_MAP),
    T.StructField("includes", T.StructType([T.StructField("users", T.ArrayType(STR_MAP))])),
    T.StructField("matching_rules", T.ArrayType(STR_MAP)),
    T.StructField("errors", T.ArrayType(STR_MAP)),
    T.StructField(CORRUPT, T.StringType()),
])

HASHTAGS_SCHEMA = T.ArrayType(STR_MAP)

# strict mode: values as VARIANT, so their JSON types can be checked
VARIANT_MAP = T.MapType(T.StringType(), T.VariantType())
STRICT_ENVELOPE_SCHEMA = T.StructType([
    T.StructField("data", VARIANT_MAP),
    T.StructField("includes", T.StructType([T.StructField("users", T.ArrayType(VARIANT_MAP))])),
    T.StructField("matching_rules", T.ArrayType(VARIANT_MAP)),
    T.StructField("errors", T.ArrayType(STR_MAP)),
    T.StructField(CORRUPT, T.StringType()),
])

# The keys a post must carry inside ``data`` and inside every user object, and the
# error title that means the stream was shut down for good.
REQUIRED_DATA_KEYS = ("id", "text", "created_at", "author_id", "source")
DISCONNECT_TITLE = "operational-disconnect"


def parse_envelope(value: Column) -> Column:
    """Lenient JSON parse of one line; malformed text fills ``_corrupt_record``."""
    return F.from_json(value, ENVELOPE_SCHEMA,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def parse_envelope_strict(value: Column) -> Column:
    """Like ``parse_envelope`` but with ``data`` values as VARIANT (see ``strict_view``)."""
    return F.from_json(value, STRICT_ENVELOPE_SCHEMA,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def strict_view(env_v: Column) -> Column:
    """The usual envelope struct (values as text: strings as they are, others as JSON text) plus the
    JSON types of the values of ``data``, each user and each rule."""
    def as_text(m):
        return F.transform_values(m, lambda k, v: F.when(
            F.schema_of_variant(v) == F.lit("STRING"), F.variant_get(v, "$", "string"))
            .when(F.schema_of_variant(v) == F.lit("VOID"), F.lit(None).cast("string"))
            .otherwise(F.to_json(v)))

    def types(m):
        return F.transform_values(m, lambda k, v: F.schema_of_variant(v))

    users, rules = env_v["includes"]["users"], env_v["matching_rules"]
    includes = F.when(env_v["includes"].isNotNull(), F.struct(F.transform(users, as_text).alias("users")))
    return F.struct(as_text(env_v["data"]).alias("data"), includes.alias("includes"),
                    F.transform(rules, as_text).alias("matching_rules"), env_v["errors"].alias("errors"),
                    env_v[CORRUPT].alias(CORRUPT), types(env_v["data"]).alias("data_types"),
                    F.transform(users, types).alias("user_types"), F.transform(rules, types).alias("rule_types"))


STRING_DATA_KEYS = REQUIRED_DATA_KEYS + ("in_reply_to_user_id",)


def last_value_of_key(maps: Column, key: str) -> Column:
    """Flatten a list of objects into one map where later objects win, then look up ``key``."""
    carrying = F.filter(maps, lambda m: F.map_contains_key(m, key))
    return F.try_element_at(F.transform(carrying, lambda m: m[key]), F.lit(-1))


def has_key_in_any(maps: Column, key: str) -> Column:
    return F.exists(maps, lambda m: F.map_contains_key(m, key))


def party_tag(rules: Column) -> Column:
    """Tag of the last matching rule that carries one; ``""`` when none does."""
    return F.coalesce(last_value_of_key(rules, "tag"), F.lit(""))


def entities(data: Column) -> Column:
    """``data.entities`` as an object of raw member texts (null when absent, null or not an object)."""
    return F.from_json(data["entities"], STR_MAP)


def hashtag_objects(ents: Column) -> Column:
    """``entities.hashtags`` as a list of objects (null when absent, null, or not a list of objects)."""
    return F.from_json(ents["hashtags"], HASHTAGS_SCHEMA)


def hashtags(tags: Column, keep_null: bool = False) -> Column:
    """Tags in order with duplicates; a missing ``tag`` counts as empty and is dropped; a JSON
    null tag is dropped too unless ``keep_null`` (the reference kept it)."""
    raw = F.transform(F.coalesce(tags, F.array()),
                      lambda h: F.when(F.map_contains_key(h, "tag"), h["tag"]).otherwise(F.lit("")))
    if keep_null:
        return F.filter(raw, lambda t: t.isNull() | (t != F.lit("")))
    return F.filter(raw, lambda t: t.isNotNull() & (t != F.lit("")))


def attachments_map(data: Column) -> Column:
    return F.from_json(data["attachments"], STR_MAP)


def attachment_count(att: Column) -> Column:
    """Number of attachment kinds (keys of the object), 0 when absent."""
    return F.coalesce(F.cardinality(att), F.lit(0)).cast("int")


def users_list(users: Column) -> Column:
    return F.transform(users, lambda u: F.struct(u["id"].alias("user_id"), u["username"].alias("username"),
                                                 u["name"].alias("name")))


def author(users: Column, author_id: Column) -> Column:
    """P5: first user whose id equals the author id (null when none)."""
    return F.get(F.filter(users, lambda u: u["id"] == author_id), F.lit(0))


def users_complete(users: Column) -> Column:
    return F.forall(users, lambda u: F.map_contains_key(u, "id") & F.map_contains_key(u, "username")
                    & F.map_contains_key(u, "name"))


def reply_to(data: Column) -> Column:
    """``in_reply_to_user_id`` or ``""`` when the key is absent."""
    return F.when(F.map_contains_key(data, "in_reply_to_user_id"), data["in_reply_to_user_id"]).otherwise(F.lit(""))


def error_title(errors: Column) -> Column:
    """Errors flattened to one map, last ``title`` wins."""
    return F.coalesce(last_value_of_key(errors, "title"), F.lit(""))


def error_action(title: Column) -> Column:
    return F.when(title == F.lit(DISCONNECT_TITLE), F.lit("stop")).otherwise(F.lit("reconnect"))


def reject_reason(env: Column, ents: Column, att: Column, tags: Column, created_ts: Column,
                  strict: bool = False) -> Column:
    """First failing rule, or null for a valid post. ``ents``/``att``/``tags``: parsed entities,
    attachments and hashtag objects; ``created_ts``: the event time.

    An envelope that yields a post is a post even if it also carries ``errors``. One that carries
    ``errors`` is an error envelope only if it lacks a part without which the parse breaks off (data,
    includes, rules, the author, whole users, well-formed hashtags or attachments); where a value is merely missing or null
    beside partial errors, it is an ordinary reject. A time that can't be read rejects the post, so
    that every post that counts as valid is in the hourly metrics.
    """
    data = env["data"]
    users = env["includes"]["users"]
    rules = env["matching_rules"]
    required_ok = F.lit(True)
    for key in REQUIRED_DATA_KEYS:
        required_ok = required_ok & data[key].isNotNull()
    rule_tag = last_value_of_key(rules, "tag")
    strict_checks = []
    if strict:
        types = env["data_types"]
        bad = F.lit(False)
        for key in STRING_DATA_KEYS:
            bad = bad | (F.map_contains_key(types, key) & ~types[key].isin("STRING", "VOID"))
        not_text = lambda m, keys: F.lit(False) if not keys else F.exists(
            F.array(*[F.coalesce(m[k], F.lit("STRING")) for k in keys]), lambda t: ~t.isin("STRING", "VOID"))
        bad = bad | F.coalesce(F.exists(env["user_types"], lambda m: not_text(m, ("id", "username", "name"))), F.lit(False))
        bad = bad | F.coalesce(~last_value_of_key(env["rule_types"], "tag").isin("STRING", "VOID"), F.lit(False))
        strict_checks = [(bad, "non_string_field")]
    checks = [
        (data.isNull(), "missing_data"),
        (users.isNull(), "missing_users"),
        (rules.isNull(), "missing_matching_rules"),
        (~required_ok, "missing_required_field"),
        *strict_checks,
        (F.map_contains_key(data, "entities") & ents.isNull(), "bad_entities"),
        (F.map_contains_key(ents, "hashtags") & tags.isNull(), "bad_entities"),
        (F.map_contains_key(data, "attachments") & att.isNull(), "bad_attachments"),
        (has_key_in_any(rules, "tag") & rule_tag.isNull(), "null_rule_tag"),
        (~users_complete(users), "incomplete_user"),
        (author(users, data["author_id"]).isNull(), "author_not_in_users"),
        (created_ts.isNull(), "bad_created_at"),
    ]
    detail = F.lit(None).cast("string")
    for cond, reason in reversed(checks):
        detail = F.when(cond, F.lit(reason)).otherwise(detail)
    unparsable = env.isNull() | env[CORRUPT].isNotNull()
    empty = (data.isNull() & env["includes"].isNull() & rules.isNull() & env["errors"].isNull())
    return (F.when(unparsable | empty, F.lit("malformed_json"))
            .when(detail.isNull(), F.lit(None).cast("string"))
            .when(env["errors"].isNotNull() & breaks_off(env, ents, att, tags), F.lit("error_envelope"))
            .otherwise(detail))


def breaks_off(env: Column, ents: Column, att: Column, tags: Column) -> Column:
    """Whether the envelope lacks a part that the parse can't do without."""
    data, users, rules = env["data"], env["includes"]["users"], env["matching_rules"]
    readable = users.isNotNull() & ~(F.map_contains_key(data, "entities") & ents.isNull()) & ~(
        has_key_in_any(rules, "tag") & last_value_of_key(rules, "tag").isNull())
    broken = ((F.map_contains_key(ents, "hashtags") & tags.isNull()) | (F.map_contains_key(data, "attachments") & att.isNull())
              | ~users_complete(users) | author(users, F.coalesce(data["author_id"], F.lit(""))).isNull())
    return data.isNull() | env["includes"].isNull() | rules.isNull() | (readable & F.coalesce(broken, F.lit(False)))
