"""Dense 0-based position of every row in a global order, without moving all rows to one task.

Rows are range-partitioned on the order key and sorted inside each partition; each row gets
``monotonically_increasing_id`` (partition index in the high bits, row index in the low bits). That
frame is checkpointed to the shared checkpoint folder so range bounds cannot change between the
two uses below. A per-partition count (one row per partition) gives each partition its offset; the
offsets table has as many rows as there are partitions, a bound fixed by the caller, so it is
broadcast. Position = offset + index inside the partition. Equal order keys are ordered by a hash
of the row, which also spreads a hot key over several partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from postwave.session import checkpoint_root


def global_position(df: DataFrame, order_cols: list[str], n_parts: int | None = None,
                    col: str = "position") -> DataFrame:
    spark = df.sparkSession
    checkpoint_root(spark)
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a hash of the whole row as the last key: rows with equal order keys (a hot key) are spread
    # over several range partitions instead of landing in one task; ties get a deterministic order
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    keyed = (df.withColumn("_tie", tie).repartitionByRange(n, *order_cols, "_tie")
             .sortWithinPartitions(*order_cols, "_tie")
             .withColumn("_pid", F.spark_partition_id())
             .withColumn("_mid", F.monotonically_increasing_id()))
    keyed = keyed.checkpoint(eager=True)
    sizes = keyed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = sizes.withColumn("_offset", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1))).fillna(0, ["_offset"])
    out = keyed.join(F.broadcast(offsets.select("_pid", "_offset", "_first")), "_pid")
    return out.withColumn(col, F.col("_offset") + F.col("_mid") - F.col("_first")).drop(
        "_pid", "_mid", "_offset", "_first", "_tie")
