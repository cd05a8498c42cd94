"""Account roster.

``;``-separated text, cells trimmed of blanks and control characters, no quoting (a ``;`` inside a
cell splits it). The first line of each file is its header, whatever it says. Rows with fewer than
six cells go to quarantine instead of aborting the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postwave.session import checkpoint_root

# Roster columns in file order.
ROSTER_COLUMNS = ("screen_name", "user_id", "name", "party", "location", "created_at")


# Never part of a line: keeps the reader of one-column files from splitting them.
_NO_SEPARATOR = "\x01"


def _cells(value_col: str):
    return F.transform(F.split(F.col(value_col), ";"), lambda s: F.regexp_replace(s, "^[\\x00-\\x20]+|[\\x00-\\x20]+$", ""))


def read_roster_lines(spark, path: str) -> DataFrame:
    """Roster text files under ``path`` as (version, block, at, value), without each file's first line.

    A file's version is its name, so rows of the file last in name order win in ``dedup_roster``. Within a file lines are in order of
    ``block`` (the offset of the split that holds them) and ``at``, which grows along a split; a file of any number of splits needs no single task."""
    lines = spark.read.schema("value string").csv(path, header=True, sep=_NO_SEPARATOR, quote="", escape="", comment="",
                                                  enforceSchema=True, mode="PERMISSIVE")
    return lines.where("value is not null").select(F.col("_metadata.file_path").alias("version"), F.col("_metadata.file_block_start").alias("block"),
                                                   F.monotonically_increasing_id().alias("at"), "value")


def line_numbers(lines: DataFrame) -> DataFrame:
    """Adds ``line``: the number (from 1) of a line among the lines of its file that ``read_roster_lines`` gave.

    Two passes over the checkpointed order columns: lines per split, whose running sums are the splits' offsets, and the place within the split."""
    checkpoint_root(lines.sparkSession)
    held = lines.checkpoint(eager=True)
    splits = held.groupBy("version", "block").agg(F.count(F.lit(1)).alias("_n"), F.min("at").alias("_first"))
    before = Window.partitionBy("version").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    out = held.join(offsets.drop("_n"), ["version", "block"])
    return out.withColumn("line", F.col("_offset") + F.col("at") - F.col("_first") + 1).drop("_offset", "_first")


def read_roster(spark, path: str) -> DataFrame:
    """S3 + S4 from files: load, drop the header and short rows, one row per user_id; the later file, then the later line wins."""
    return dedup_roster(load_roster(read_roster_lines(spark, path)), ("version", "block", "at"))


def load_roster(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """S3: one row per roster line (no header) with six or more cells; other columns of ``lines`` are kept."""
    keep = [c for c in lines.columns if c != value_col]
    cells = _cells(value_col)
    parsed = lines.select(*keep, cells.alias("_c"))
    parsed = parsed.where(F.size("_c") >= len(ROSTER_COLUMNS))
    return parsed.select(*keep, *[F.col("_c")[i].alias(n) for i, n in enumerate(ROSTER_COLUMNS)])


def roster_rejects(lines: DataFrame, value_col: str = "value") -> DataFrame:
    cells = _cells(value_col)
    return (lines.select(F.col(value_col).alias("line"), cells.alias("_c"))
            .where(F.size("_c") < len(ROSTER_COLUMNS))
            .select("line", F.lit("too_few_cells").alias("reason")))


def dedup_roster(roster: DataFrame, order_cols: tuple[str, ...] = ("version",)) -> DataFrame:
    """One row per user_id; the row with the greatest ``order_cols`` wins (then the greatest row, where these don't tell two rows apart).

    ``max_by`` is a partial aggregate, so a user_id repeated in a third of the file is combined
    map-side before the shuffle.
    """
    cols = list(ROSTER_COLUMNS)
    order = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in cols])
    best = roster.groupBy("user_id").agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("r"))
    return best.select(*[F.col("r")[c].alias(c) for c in cols])
