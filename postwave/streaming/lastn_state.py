"""Last n post ids per party as keyed state.

``sinks.tables.merge_last_n`` reads and writes every party's stored list in each batch. Here the lists live in Spark's
arbitrary stateful operator: one list state of at most n (time, id) pairs per party in RocksDB, so a batch touches the parties that it
holds and nothing else, and a restart goes on from the checkpoint. Recency is by event time, then id, whatever the order of files;
a post that arrives twice counts twice, as in the batch form.

Before the shuffle each task keeps only its n newest posts of each party, so a party with a third of all posts sends n rows per task.

A changed list is sent at once, or, with ``every``, when a processing-time timer fires: at most once in that time for each party, however
short the trigger. The sink replaces rows by (party, recency); lists never get shorter, so the latest row of each key is the list.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from postwave.operators import lastn

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "party string, recency int, id string, ts timestamp"


def _newest(table: pa.Table, n: int) -> pa.Table:
    """The n newest rows (party, id, created_ts) of each party."""
    table = table.sort_by([("party", "ascending"), ("created_ts", "descending"), ("id", "descending")])
    parties = table.column("party").to_pylist()
    keep, at = [], 0
    for i, p in enumerate(parties):
        at = 0 if i == 0 or p != parties[i - 1] else at + 1
        keep.append(at < n)
    return table.filter(pa.array(keep, pa.bool_()))


def newest_per_task(posts: DataFrame, n: int = lastn.LAST_N) -> DataFrame:
    """Each task's n newest posts of each party; holds parties x n rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = _newest(t if held is None else pa.concat_tables([held, t]), n)
        if held is not None:
            yield from held.combine_chunks().to_batches()

    columns = posts.select("party", "id", "created_ts")
    return columns.mapInArrow(run, "party string, id string, created_ts timestamp")


class LastN(StatefulProcessor):
    """Keeps the n newest (time, id) of a party; emits the list when it changed, or when the timer set by a change fires."""

    def __init__(self, n: int = lastn.LAST_N, every_ms: int | None = None):
        self.n, self.every_ms = n, every_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getListState("newest", "ts timestamp, id string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        old = [(pd.Timestamp(ts), i) for ts, i in self.newest.get()] if self.newest.exists() else []
        both = old + [(pd.Timestamp(ts), i) for part in rows for ts, i in zip(part["created_ts"], part["id"])]
        now = sorted(both, reverse=True)[:self.n]
        if now == old:
            return
        self.newest.put([(ts.to_pydatetime(), i) for ts, i in now])
        if self.every_ms is None:
            yield self._rows(key[0], now)
        elif not list(self.handle.listTimers()):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self._rows(key[0], [(pd.Timestamp(ts), i) for ts, i in self.newest.get()])

    def close(self) -> None:
        pass

    @staticmethod
    def _rows(party: str, newest: list) -> pd.DataFrame:
        return pd.DataFrame({"party": [party] * len(newest), "recency": list(range(1, len(newest) + 1)), "id": [i for _, i in newest],
                             "ts": [ts for ts, _ in newest]})


def last_n_state(posts: DataFrame, n: int = lastn.LAST_N, every_ms: int | None = None) -> DataFrame:
    """A stream of the lists that changed: (party, recency, id, ts)."""
    return newest_per_task(posts, n).groupBy("party").transformWithStateInPandas(
        LastN(n, every_ms), outputStructType=OUTPUT, outputMode="Update", timeMode="ProcessingTime" if every_ms else "None")


@contextmanager
def rocksdb(spark: SparkSession):
    """RocksDB as state store of a stream that starts within."""
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, old)
