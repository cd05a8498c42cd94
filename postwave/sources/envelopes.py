"""Line sources of envelopes.

The reference read an HTTP stream through a hand-written micro-batch reader. Here the stream is a
folder of text files (one envelope per line) read by Spark's file source, in batch or as a stream;
any other line source (Kafka ``value``, a socket in tests) plugs into the same parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.functions.exprs import once


#: Spark's file source skips files older than its newest by a week; a backlog may be older.
NO_AGE_LIMIT = "36500d"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch: one row per line, column ``value``."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, consume: bool = False) -> DataFrame:
    """Streaming frame of lines from files arriving in ``path``, however old they are; ``consume`` deletes files whose batch is committed."""
    r = spark.readStream.format("text").option("maxFileAge", NO_AGE_LIMIT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if consume:
        r = r.option("cleanSource", "delete")
    return r.load(path)


def unwrap_replay(v: Column, value: Column) -> Column:
    """The string field ``tweet`` of a replay line; ``""`` when it is missing or not a string.

    ``v`` is the line parsed once into a VARIANT (``try_parse_json``); a line that is not a JSON
    object gives null (skipped by ``replay_envelopes``). Only the ``tweet`` member is inspected.
    """
    is_object = v.isNotNull() & F.startswith(F.ltrim(value), F.lit("{"))
    member = F.variant_get(v, "$.tweet", "variant")
    is_string = F.schema_of_variant(member) == F.lit("STRING")
    return (F.when(~is_object, F.lit(None).cast("string"))
            .when(is_string, F.variant_get(v, "$.tweet", "string"))
            .otherwise(F.lit("")))


def replay_envelopes(replay: DataFrame, value_col: str = "value") -> DataFrame:
    """Replay lines to envelope lines (column ``value``), unparsable lines skipped."""
    keep = [c for c in replay.columns if c != value_col]
    parsed = replay.select(*keep, F.col(value_col).alias("_raw"), once(F.try_parse_json(F.col(value_col)), "_v"))
    out = parsed.select(*keep, once(unwrap_replay(F.col("_v"), F.col("_raw")), "value"))
    return out.where(F.col("value").isNotNull())
