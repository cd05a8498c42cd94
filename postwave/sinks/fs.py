"""File-system helpers over Hadoop's FileSystem API (works for local, HDFS and object stores)."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create ``path`` so a stream can start on a table its upstream query has not written yet."""
    p, fs = _fs(spark, path)
    fs.mkdirs(p)


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def move_files(spark: SparkSession, path: str, to: str) -> None:
    """Renames the files of folder ``path`` into folder ``to`` (marks of the writer, such as ``_SUCCESS``, excepted) and deletes ``path``."""
    p, fs = _fs(spark, path)
    ensure_dir(spark, to)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in names(spark, path, ""):
        if not name.startswith(("_", ".")) and not fs.rename(path_of(p, name), path_of(to, name)):
            raise OSError(f"cannot rename {path}/{name} into {to}")
    fs.delete(p, True)


def names(spark: SparkSession, path: str, prefix: str, committed: bool = False) -> list[str]:
    """What follows ``prefix`` in the names in folder ``path``; ``committed``: of finished writes (``_SUCCESS``) only."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [st.getPath().getName()[len(prefix):] for st in fs.listStatus(p) if st.getPath().getName().startswith(prefix)
            and (not committed or fs.exists(path_of(st.getPath(), "_SUCCESS")))]


def numbered(spark: SparkSession, path: str, prefix: str, committed: bool = False) -> list[int]:
    return sorted(int(n) for n in names(spark, path, prefix, committed) if n.isdigit())


def run_number(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The number of the streaming query of ``checkpoint`` among those that have written table ``path``.

    The query's id is in its checkpoint from its first start on; the table's folder ``_runs`` remembers
    which number it got. A new checkpoint is a new query with the next number."""
    query_id = json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
    known = dict(reversed(n.split("_", 1)) for n in names(spark, f"{path.rstrip('/')}/_runs", ""))
    if query_id not in known:
        known[query_id] = str(1 + max(map(int, known.values()), default=-1))
        ensure_dir(spark, f"{path.rstrip('/')}/_runs/{known[query_id]}_{query_id}")
    return int(known[query_id])


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """``path`` with this text, seen whole or not at all: written beside it, then renamed."""
    p, fs = _fs(spark, path)
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.tmp")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(aside, p):
        raise OSError(f"cannot rename to {path}")


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
