"""Roster chunks to stream filter rules.

Accounts are ordered by user_id and cut into chunks of ``chunk_size``; each chunk becomes
``from:a OR from:b ... <suffix>`` with tag ``<prefix><chunk number>`` wrapped in an ``add`` object.
Chunk numbers come from a global position computed without a single-task window, and each group
holds at most ``chunk_size`` accounts, so collecting a chunk is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwave.operators.ranking import global_position

# The rule text around the account list, the tag prefix and the default chunk size.
RULE_SUFFIX = " lang:de -is:retweet"
TAG_PREFIX = "MdBList"
CHUNK_SIZE = 20
RULE_OPEN = '{ "add": [ { "value": "'
RULE_MID = '","tag": "'
RULE_CLOSE = '"}]}'


def roster_rules(roster: DataFrame, chunk_size: int = CHUNK_SIZE, tag_prefix: str = TAG_PREFIX,
                 suffix: str = RULE_SUFFIX, n_parts: int | None = None) -> DataFrame:
    """(chunk, tag, n_accounts, rule) with chunk numbers 1.. in user_id order."""
    pos = global_position(roster.select("user_id", "screen_name"), ["user_id", "screen_name"], n_parts)
    chunked = pos.withColumn("chunk", (F.expr(f"position div {int(chunk_size)}") + 1).cast("int"))
    grouped = chunked.groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("position", "screen_name"))).alias("m"))
    names = F.array_join(F.transform("m", lambda x: F.concat(F.lit("from:"), x["screen_name"])), " OR ")
    tag = F.concat(F.lit(tag_prefix), F.col("chunk").cast("string"))
    rule = F.concat(F.lit(RULE_OPEN), names, F.lit(suffix), F.lit(RULE_MID), tag, F.lit(RULE_CLOSE))
    return grouped.select("chunk", tag.alias("tag"), F.size("m").alias("n_accounts"), rule.alias("rule"))
