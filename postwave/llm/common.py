"""Shared helpers of the llm operators: scratch tables, Arrow batch limits, small input slices."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from postwave.session import checkpoint_root
from postwave.sinks.fs import delete

#: Bytes of text that a vectorised step handles at once; a longer text is handled alone.
SLICE_BYTES = 1 << 21
#: Rows and bytes that Spark hands a Python worker in one Arrow batch.
ARROW_ROWS, ARROW_BYTES = "2000", str(16 << 20)


def ready(spark: SparkSession) -> SparkSession:
    """Python workers can import this package, and Arrow batches stay small, as texts may be very long.

    The package goes to the executors with the job, wherever the driver has it from; Arrow limits that
    the user has set stay."""
    sc = spark.sparkContext
    if not getattr(sc, "_postwave_shipped", False):
        import postwave

        root = os.path.dirname(os.path.abspath(postwave.__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="postwave-"), "postwave.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in sorted(os.walk(root)):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
        sc._postwave_shipped = True
    for key, value, default in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS, "10000"),
                                ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES, None)):
        now = spark.conf.get(key, None)
        if now is None or now == default or default is None:
            spark.conf.set(key, value)
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a scratch table and read back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    w = df.write.option("compression", "zstd")
    w.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes scratch tables (as ``stored`` returned them) that nothing will read again."""
    for t in tables:
        path = getattr(t, "_scratch", None)
        if path is not None:
            delete(t.sparkSession, path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df`` written once, dealt by ``key`` into a file for each of as many buckets as there are shuffle partitions: joins on the key don't move it again.

    The session's catalog knows the table until ``forget``; its files lie in the scratch folder."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table, path = f"{name}_{uuid.uuid4().hex}", scratch(spark, name)
    df.repartition(n, key).write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(n, key).sortBy(key).saveAsTable(table)
    out = spark.table(table)
    out._scratch, out._table = path, table
    return out


def forget(table: DataFrame) -> None:
    """Takes a bucketed table out of the catalog and deletes its files."""
    table.sparkSession.sql(f"DROP TABLE IF EXISTS {table._table}")
    discard(table)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of finished jobs now, not when the driver next collects its
    garbage: first Python's (its DataFrames hold the JVM's), then the JVM's."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes in each part (one row at least)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        total = col.nbytes
        if total <= limit or batch.num_rows <= 1:
            if batch.num_rows:
                yield batch
            continue
        at, size, k = 0, 0, 0
        for k, value in enumerate(col):
            n = len(value.as_buffer()) if value.is_valid else 0
            if size and size + n > limit:
                yield batch.slice(at, k - at)
                at, size = k, 0
            size += n
        yield batch.slice(at)


def encoded(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [b or b"" for b in col.to_pylist()]
