"""Streaming queries registered for the check: ``(spark, sf_dir) -> DataFrame``.

Each one lands the envelope lines Spark derives from the whole tables as gzipped text files in a fresh
folder under the shared checkpoint folder, runs the streaming jobs with ``availableNow`` (several
micro-batches, real checkpoints and sinks), and returns the sink table read back in batch. More lines
make more files and, beyond ``FILES_PER_BATCH``, more batches. They land in turns (``MOST_TURNS`` at most), each
ingested from the checkpoint of the turn before and deleted, so that the disk never holds all lines beside the posts. The next turn
lands while the streams go over one, so cores that these leave idle (starts, commits, last tasks) make lines. Where the posts
are not the result, the streams that read them go on after each turn as well, and what all have read is deleted (``_then``).
``stream_late_posts`` lands the lines unclustered and reads few files per batch with the
application's own settings, so that most batches hold posts of all hours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postwave.operators import metrics as M
from postwave.session import scratch_path, session_beside
from postwave.sinks import fs
from postwave.sinks.tables import read_last_n
from postwave.sources import tables
from postwave.streaming import progress
from postwave.streaming import queries as SQ


#: Files that a batch of the ingest reads at most; its shuffle and state of work grow no further.
FILES_PER_BATCH = 48
#: Turns in which the lines land at most: each reads the tables once more.
MOST_TURNS = 32


def land_envelopes(spark: SparkSession, sf_dir: str, n_files: int = 8) -> str:
    """Write the envelope lines as ``n_files`` text files or more, each holding one range of event time."""
    path = scratch_path(spark, "envelopes")
    tables.land_envelope_files(spark, sf_dir, path, n_files)
    return path


def _batch_of(files: int, batches: int) -> int:
    """Files per trigger for so many batches, or more if these would be large."""
    return max(1, min(-(-files // batches), FILES_PER_BATCH))


def _landed(spark: SparkSession, sf_dir: str, path: str, at_least: int, by_time: bool = True, lot: int | None = None) -> Iterator[int]:
    """Lands the lines in turns (of time, or dealt by a hash), one for each batch of files; yields how many files all turns have; a turn's are deleted once the caller has read them.
    While the caller reads a turn in ``path`` the next one lands beside it; it comes into ``path`` whole, when its time has come."""
    files = tables.file_count(spark, sf_dir, at_least, lot)
    turns = min(MOST_TURNS, -(-files // FILES_PER_BATCH))
    cuts = tables.time_cuts(spark, sf_dir, turns) if by_time else None
    own = session_beside(spark)

    def land(i: int) -> str:
        aside = f"{path}-next-{lot}-{i}"
        tables.land_envelope_files(own, sf_dir, aside, at_least, by_time, lot, (i, turns), cuts)
        return aside

    with ThreadPoolExecutor(1) as beside:
        landing = beside.submit(land, 0)
        for i in range(turns):
            fs.move_files(spark, landing.result(), path)
            if i + 1 < turns:
                landing = beside.submit(land, i + 1)
            yield files
            fs.delete(spark, path)
            fs.ensure_dir(spark, path)


def _ingest(spark: SparkSession, src: str, out: str, files: int) -> StreamingQuery:
    q = SQ.start_ingest(spark, src, f"{out}/posts", f"{out}/ck_ingest", available_now=True, max_files_per_trigger=files, consume=True)
    q.awaitTermination()
    return q


def _then(spark: SparkSession, out: str, start: Callable[[str], StreamingQuery]) -> None:
    """The stream that reads the posts goes on over those of the turn, which then go."""
    start(out).awaitTermination()
    SQ.drop_read(spark, f"{out}/posts")


def _ingested(spark: SparkSession, sf_dir: str, start: Callable[[str], StreamingQuery] | None = None) -> str:
    """``start``: the stream over the posts; without one all posts stay."""
    src, out = scratch_path(spark, "envelopes"), scratch_path(spark, "stream")
    for files in _landed(spark, sf_dir, src, 8):
        _ingest(spark, src, out, _batch_of(files, 4))
        if start:
            _then(spark, out, start)
    return out


def _ingested_unclustered(spark: SparkSession, sf_dir: str, name: str, start: Callable[[str], StreamingQuery]) -> str:
    src, out = scratch_path(spark, "unclustered"), scratch_path(spark, name)
    for files in _landed(spark, sf_dir, src, 12, by_time=False):
        _ingest(spark, src, out, _batch_of(files, 3))
        _then(spark, out, start)
    return out


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _ingested(spark, sf_dir)
    return SQ.read_posts(spark, f"{out}/posts").select("id", "party", "createdDate", "user_id", "attachments")


def _metric(spec: M.MetricSpec):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = _ingested(spark, sf_dir, lambda out: SQ.start_metric(spark, f"{out}/posts", spec, f"{out}/{spec.name}", f"{out}/ck_{spec.name}",
                                                                   available_now=True))
        return SQ.read_metric(spark, f"{out}/{spec.name}", spec).select(*SQ.metric_keys(spec), spec.measure_name)
    return run


def q_stream_sentiment_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _metric(M.SENTIMENT_BY_HOUR_PARTY)(spark, sf_dir)
    return out.withColumn("sentiment", F.round("sentiment", 9))


def q_stream_late_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = M.POSTS_BY_HOUR_PARTY
    out = _ingested_unclustered(spark, sf_dir, "late", lambda out: SQ.start_metric(spark, f"{out}/posts", spec, f"{out}/{spec.name}", f"{out}/ck",
                                                                                   available_now=True, max_files_per_trigger=60))
    return SQ.read_metric(spark, f"{out}/{spec.name}", spec).select(*SQ.metric_keys(spec), spec.measure_name)


def _last15(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _ingested(spark, sf_dir, lambda out: SQ.start_last_n(spark, f"{out}/posts", f"{out}/last15", f"{out}/ck_last15", available_now=True))
    return read_last_n(spark, f"{out}/last15")


def q_stream_last15_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _last15(spark, sf_dir).where("scope = 'combined'").select("recency", "id")


def q_stream_last15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _last15(spark, sf_dir).where("scope = 'party'").select("party", "recency", "id")


def q_stream_last15_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without any order of time arrive in two lots; the second is met after a restart from the checkpoint."""
    path, out = scratch_path(spark, "lots"), scratch_path(spark, "keyed")
    for lot in (1, 0):
        for files in _landed(spark, sf_dir, path, 12, by_time=False, lot=lot):
            _ingest(spark, path, out, _batch_of(files, 3))
            _then(spark, out, lambda out: SQ.start_last_n_state(spark, f"{out}/posts", f"{out}/last15", f"{out}/ck", available_now=True,
                                                                max_files_per_trigger=60, state_partitions=4))
    return SQ.read_last_n_state(spark, f"{out}/last15").where("scope = 'party'").select("party", "recency", "id")


def q_stream_late_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch holds posts of all hours and a watermark of one hour follows the newest: what is behind it is added as corrections."""
    spec = M.POSTS_BY_HOUR_PARTY
    out = _ingested_unclustered(spark, sf_dir, "merged", lambda out: SQ.start_metric_merged(
        spark, f"{out}/posts", spec, f"{out}/{spec.name}", f"{out}/ck", "1 hour", available_now=True, max_files_per_trigger=20, fold_every=4))
    return SQ.read_metric_merged(spark, f"{out}/{spec.name}", spec)


def q_stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 from the stored progress: the ingest stream reads two lots of files, with a restart between them."""
    path, out = scratch_path(spark, "lots"), scratch_path(spark, "progress")
    log = progress.ProgressLog(spark, f"{out}/progress", fold_every=4).attach()
    try:
        for lot in (1, 0):
            for files in _landed(spark, sf_dir, path, 10, by_time=False, lot=lot):
                q = _ingest(spark, path, out, _batch_of(files, 5))
                progress.wait_for(spark, f"{out}/progress", q)
                SQ.drop_read(spark, f"{out}/posts")             # no stream reads them here
    finally:
        log.detach()
    got = progress.totals(spark, f"{out}/progress").where(F.col("query") == str(q.id))
    return got.select("lines", "valid", "rejected", "error_envelopes", F.col("rows_dropped").alias("dropped"), F.col("failed").cast("long").alias("failed"))


def q_stream_state_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of a metric's stream, read back after a restart, beside the metric table's rows of the same keys."""
    src, out, spec = scratch_path(spark, "envelopes"), scratch_path(spark, "audit"), M.POSTS_BY_HOUR_PARTY

    def start(out: str) -> StreamingQuery:
        return SQ.start_metric(spark, f"{out}/posts", spec, f"{out}/{spec.name}", f"{out}/ck", available_now=True, state_partitions=4)

    for files in _landed(spark, sf_dir, src, 8):
        _ingest(spark, src, out, _batch_of(files, 3))
        _then(spark, out, start)
    _ingest(spark, src, out, _batch_of(files, 4))
    _then(spark, out, start)                        # once more from the checkpoint
    return SQ.audit_state(spark, f"{out}/ck", f"{out}/{spec.name}", spec)


STREAM_QUERIES = {
    "stream_ingest": q_stream_ingest,
    "stream_posts_by_hour": _metric(M.POSTS_BY_HOUR_PARTY),
    "stream_hashtags_by_hour": _metric(M.HASHTAGS_BY_HOUR),
    "stream_hashtags_by_hour_party": _metric(M.HASHTAGS_BY_HOUR_PARTY),
    "stream_media_by_kind_hour": _metric(M.MEDIA_BY_KIND_HOUR_PARTY),
    "stream_media_by_hour": _metric(M.MEDIA_BY_HOUR_PARTY),
    "stream_source_by_hour": _metric(M.SOURCE_BY_HOUR_PARTY),
    "stream_active_users_by_hour": _metric(M.ACTIVE_USERS_BY_HOUR_PARTY),
    "stream_sentiment_by_hour": q_stream_sentiment_by_hour,
    "stream_last15": q_stream_last15,
    "stream_last15_combined": q_stream_last15_combined,
    "stream_last15_state": q_stream_last15_state,
    "stream_late_posts": q_stream_late_posts,
    "stream_late_corrections": q_stream_late_corrections,
    "stream_progress": q_stream_progress,
    "stream_state_audit": q_stream_state_audit,
}
