"""Durable progress of streams (A10, K5).

Spark keeps a query's last progress reports in the driver's memory only. ``ProgressLog`` is a ``StreamingQueryListener`` that stores each batch's
report as it comes: rows read, late rows that a watermark dropped, rows of state, the observed counts (lines, valid, rejected, error envelopes),
and the message of a query that failed. One small file per batch, in a folder per query; after every ``FOLD_EVERY`` files they are put together into one, so
files don't pile up. Who reads meanwhile takes the small files' texts at once (they go when they are put together) and the others, which stay, by Spark.
A query keeps its id when it restarts, so its totals go on.

A report is stored after its batch was committed: if the driver dies in between, that one report is missing, and it would be the only one
(``ingest_counts`` counts the ingest table itself).
"""

from __future__ import annotations

import json
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from postwave.sinks import fs

FOLD_EVERY = 100
SCHEMA = ("query string, run string, name string, batch long, time string, rows_read long, rows_dropped long, state_rows long, "
          "lines long, valid long, rejected long, error_envelopes long, failed string")


class ProgressLog(StreamingQueryListener):
    """Stores the reports of all queries of a session under ``path``; ``attach`` registers it."""

    def __init__(self, spark: SparkSession, path: str, fold_every: int = FOLD_EVERY):
        self.spark, self.path, self.fold_every = spark, path.rstrip("/"), fold_every

    def attach(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = json.loads(event.progress.json)
        row = {"query": p["id"], "run": p["runId"], "name": p.get("name"), "batch": p["batchId"], "time": p["timestamp"], "rows_read": p.get("numInputRows", 0),
               "rows_dropped": sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in p.get("stateOperators", [])),
               "state_rows": sum(int(s.get("numRowsTotal", 0)) for s in p.get("stateOperators", []))}
        row |= (p.get("observedMetrics") or {}).get("ingest_counts") or {}
        # A batch without input reports again under the number of the next one; only what it dropped would be new, and it reads nothing.
        if row["rows_read"] or row["rows_dropped"]:
            self._store(p["id"], f"{p['batchId']}", row)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.exception:
            self._store(str(event.id), f"failed-{event.runId}", {"query": str(event.id), "run": str(event.runId), "failed": str(event.exception)[:2000]})

    def _store(self, query: str, name: str, row: dict) -> None:
        folder = f"{self.path}/query={query}"
        fs.ensure_dir(self.spark, folder)
        fs.write_text(self.spark, f"{folder}/{name}.json", json.dumps(row) + "\n")
        small = [n for n in fs.names(self.spark, folder, "") if n.endswith(".json") and not n.startswith(("_", "upto-"))]
        if len(small) >= self.fold_every:
            text = "".join(fs.read_text(self.spark, f"{folder}/{n}") for n in sorted(small))
            fs.write_text(self.spark, f"{folder}/upto-{name}.json", text)
            for n in small:
                fs.delete(self.spark, f"{folder}/{n}")


_ATTACHED: dict[str, ProgressLog] = {}


def attach(spark: SparkSession, path: str) -> ProgressLog:
    """The log of this path, registered once."""
    if path not in _ATTACHED:
        _ATTACHED[path] = ProgressLog(spark, path).attach()
    return _ATTACHED[path]


def detach_all() -> None:
    while _ATTACHED:
        _ATTACHED.popitem()[1].detach()


def wait_for(spark: SparkSession, path: str, query: StreamingQuery, seconds: float = 30.0) -> bool:
    """Waits until the report of a query's last batch with input is stored: reports reach the listener on a thread of their own."""
    batches = [json.loads(p.json) for p in query.recentProgress]
    last = max((p["batchId"] for p in batches if p.get("numInputRows")), default=None)
    until = time.monotonic() + seconds
    while last is not None and read_progress(spark, path).where((F.col("query") == str(query.id)) & (F.col("batch") >= last)).isEmpty():
        if time.monotonic() > until:
            return False
        time.sleep(0.2)
    return True


def _stored(spark: SparkSession, path: str) -> list[str]:
    folders = [f"{path.rstrip('/')}/query={q}" for q in fs.names(spark, path, "query=")]
    return sorted(f"{folder}/{n}" for folder in folders for n in fs.names(spark, folder, "") if n.endswith(".json") and not n.startswith("_"))


def _snapshot(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The files that stay (put together) and the lines of the small ones (fewer than ``fold_every`` a query), all of one moment: read until nothing changed meanwhile."""
    while True:
        files = _stored(spark, path)
        small = [f for f in files if not f.rpartition("/")[2].startswith("upto-")]
        try:
            lines = [line for f in small for line in fs.read_text(spark, f).splitlines() if line]
        except Py4JJavaError as e:
            if "FileNotFoundException" not in str(e.java_exception):
                raise
            continue
        if _stored(spark, path) == files:
            return [f for f in files if f not in small], lines


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch (and per failed run); a batch that ran twice counts as it ran last."""
    kept, lines = _snapshot(spark, path)
    rows = spark.createDataFrame([(line,) for line in lines], "line string").select(F.from_json("line", SCHEMA).alias("r")).select("r.*")
    if kept:
        rows = rows.unionByName(spark.read.schema(SCHEMA).json(kept))
    rest = [c.split()[0] for c in SCHEMA.split(", ") if c.split()[0] not in ("query", "batch")]
    key = F.when(F.col("batch").isNull(), F.col("run"))
    latest = rows.groupBy("query", "batch", key.alias("_failed_run")).agg(F.max_by(F.struct(*rest), F.coalesce("time", F.lit(""))).alias("r"))
    return latest.select("query", "batch", *[F.col("r")[c].alias(c) for c in rest])


def totals(spark: SparkSession, path: str) -> DataFrame:
    """Per query: batches with input, rows read and dropped, the greatest state, ingest counts, failed runs."""
    rows = read_progress(spark, path)
    sums = ["rows_read", "rows_dropped", "lines", "valid", "rejected", "error_envelopes"]
    return rows.groupBy("query").agg(F.max("name").alias("name"), F.count_if(F.col("rows_read") > 0).alias("batches"), F.max("state_rows").alias("state_rows"),
                                     *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], F.count_if(F.col("failed").isNotNull()).alias("failed"))
