"""Session helpers: a local session for tests and benches, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession


def _driver_memory() -> str:
    """60% of physical memory, at least 2 GiB (a local session runs everything in the driver)."""
    if os.environ.get("POSTWAVE_DRIVER_MEMORY"):
        return os.environ["POSTWAVE_DRIVER_MEMORY"]
    try:
        with open("/proc/meminfo") as f:
            kb = int(next(line for line in f if line.startswith("MemTotal")).split()[1])
        gib = max(2, int(kb / 1024 / 1024 * 0.6))
    except (OSError, StopIteration, ValueError):
        gib = 4
    return f"{gib}g"


def cluster_conf(total_input_bytes: int | None = None) -> dict[str, str]:
    """Settings for a large cluster (pass to the session builder or spark-submit).

    For batch jobs: AQE decides the reduce-side partition count from the real shuffle sizes (one partition per
    128 MiB of input to start with, coalesced to ~256 MiB) and splits skewed join partitions. Streams size their
    state on their own (``state_partitions`` of the stream starters); it lives in RocksDB, off the JVM heap.
    """
    initial = str(max(200, total_input_bytes // (128 << 20))) if total_input_bytes else "8192"
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": initial,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": initial,
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def build_session(master: str | None = None, app: str = "postwave", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings the library assumes (UTC, AQE, no UI).

    What is set outside (spark-submit, ``PYSPARK_SUBMIT_ARGS``, a running session) stays; only arguments
    given here go before it. Without either: a local session of 8 threads and 8 shuffle partitions."""
    given: dict[str, str] = {}
    active = SparkSession.getActiveSession()
    if active is not None:
        given = {k: "" for k, _ in active.sparkContext.getConf().getAll()}
    elif "PYSPARK_GATEWAY_PORT" in os.environ or "PYSPARK_SUBMIT_ARGS" in os.environ:
        SparkContext._ensure_initialized()
        given = dict(SparkConf().getAll())
    wanted = {
        "spark.master": os.environ.get("POSTWAVE_MASTER", "local[8]"),
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": _driver_memory(),
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    wanted = {k: v for k, v in wanted.items() if k not in given}
    if master is not None:
        wanted["spark.master"] = master
    if shuffle_partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if given.get("spark.master", wanted.get("spark.master", "")).startswith("local") is False:
        wanted.pop("spark.driver.memory", None)         # a cluster's driver is sized by who submits
        if shuffle_partitions is None:
            wanted.pop("spark.sql.shuffle.partitions", None)
    spark = SparkSession.builder.appName(app).config(map={**wanted, **(extra or {})}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be given (a shared file system). Only a local-mode session with
    nothing set gets a fresh folder of its own, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="postwave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    sc.setCheckpointDir(conf)
    return (sc.getCheckpointDir() or conf).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for stream state, landed tables, etc."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def session_beside(spark: SparkSession) -> SparkSession:
    """A session with the same settings, for jobs on a thread of their own: what either sets for a while doesn't reach the other."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What runs within (and streams that start within) deletes its shuffle files when each job is done, and not when the driver's JVM next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "true")
        yield
    finally:
        spark.conf.set(key, old)
