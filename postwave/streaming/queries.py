"""Structured Streaming jobs.

The reference started nine queries on one source, so every query re-parsed and re-scored every
post. Here one ingest query parses each envelope once and lands posts (and rejects) as Parquet;
the metric and last-n queries read that table as a stream. Each query has its own checkpoint,
so a restart resumes where it stopped and an executor loss re-runs only the failed batch; all
sinks are idempotent per batch (``postwave.sinks.tables``).

Event time is ``created_ts`` (the reference stamped processing time). There is no watermark unless
asked for: which posts are late depends on how files fall into batches, and late posts are dropped
(``rows_dropped`` counts them, from the progress that ``run_all`` stores); with one, Spark drops the
state of closed hours. ``start_metric_merged`` needs neither: no state, and late posts are added as corrections.
``processing_time=True`` gives the reference's processing-time buckets instead.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postwave.functions.timekeys import hour_key, utc_date
from postwave.operators import lastn
from postwave.operators import metrics as M
from postwave.operators import parse
from postwave.session import shuffles_dropped
from postwave.sinks import fs, hours
from postwave.sinks import tables as sinks
from postwave.sources.envelopes import NO_AGE_LIMIT, replay_envelopes, stream_lines
from postwave.streaming import progress
from postwave.streaming.lastn_state import last_n_state, rocksdb

ENVELOPES_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("user_id", T.StringType()), T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("hashtags", T.ArrayType(T.StringType())),
    T.StructField("users", T.ArrayType(T.StructType([T.StructField("user_id", T.StringType()),
                                                     T.StructField("username", T.StringType()),
                                                     T.StructField("name", T.StringType())]))),
    T.StructField("party", T.StringType()), T.StructField("createdDate", T.StringType()),
    T.StructField("in_reply_to_user_id", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("sentiment", T.DoubleType()), T.StructField("attachments", T.IntegerType()),
    T.StructField("json", T.StringType()), T.StructField("json_before", T.StringType()),
    T.StructField("json_after", T.StringType()), T.StructField("created_ts", T.TimestampType()),
    T.StructField("reason", T.StringType()), T.StructField("error_title", T.StringType()),
    T.StructField("error_action", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("date", T.DateType()),
])


def trigger(w, available_now: bool, interval: str | None, name: str | None = None):
    if name:
        w = w.queryName(name)
    if available_now:
        return w.trigger(availableNow=True)
    if interval:
        return w.trigger(processingTime=interval)
    return w


def start_ingest(spark: SparkSession, source_dir: str, table_path: str, checkpoint: str,
                 available_now: bool = False, interval: str | None = None,
                 max_files_per_trigger: int | None = None, name: str | None = None,
                 strict: bool = False, replay: bool = False, spread: int | None = None,
                 consume: bool = False) -> StreamingQuery:
    """S1 + K1/K2: envelope files -> one table of every line, partitioned ``kind=post|reject/date=``.

    Posts (with the raw envelope, its text stored once: ``parse.text_once``) and quarantined lines come out of one pass, written
    by Spark's file sink: its ``_spark_metadata`` log makes the table exactly-once for streaming and
    batch readers alike (a retried batch never shows twice). A10: the per-batch counts of lines,
    posts, rejects and error envelopes are observed metrics of the query
    (``query.lastProgress['observedMetrics']['ingest_counts']``; totals via ``ingest_counts``).

    Rows of a batch are rebalanced by kind and date before the write: adaptive execution splits a date by its size (live traffic has
    one date, which any number of tasks then writes) and puts small ones together, so files come in the advisory size however lines are
    mixed. ``spread`` instead deals each kind and date to that many tasks. ``replay`` reads captured replay lines. ``consume`` deletes the files of committed batches.
    A batch's shuffle is deleted when the batch is done, and the table is written with zstd; read it with ``read_posts``, ``read_rejects`` or ``posts_stream``."""
    lines = stream_lines(spark, source_dir, max_files_per_trigger, consume)
    if replay:
        lines = replay_envelopes(lines)
    rows = parse.classify(parse.parse_lines(lines, strict=strict)).withColumn("date", utc_date(F.col("created_ts")))
    rows = rows.observe("ingest_counts", F.count(F.lit(1)).alias("lines"),
                        F.count_if(F.col("kind") == "post").alias("valid"),
                        F.count_if(F.col("kind") == "reject").alias("rejected"),
                        F.count_if(F.col("reason") == "error_envelope").alias("error_envelopes"))
    rows = parse.text_once(rows)
    line = F.xxhash64("json", "json_before", "text", "json_after")
    rows = rows.repartition("kind", "date", F.pmod(line, F.lit(spread))) if spread else rows.hint("rebalance", "kind", "date")
    w = (rows.writeStream.format("parquet").outputMode("append").partitionBy("kind", "date").option("compression", "zstd")
         .option("path", table_path).option("checkpointLocation", checkpoint))
    with shuffles_dropped(spark):
        return trigger(w, available_now, interval, name).start()


def ingest_counts(spark: SparkSession, table_path: str) -> dict[str, int]:
    """A10: lines, valid, rejected and error_envelopes of all that an ingest table holds, however long its stream ran."""
    rows = spark.read.schema(ENVELOPES_SCHEMA).parquet(table_path).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("kind") == "post").alias("valid"),
        F.count_if(F.col("kind") == "reject").alias("rejected"),
        F.count_if(F.col("reason") == "error_envelope").alias("error_envelopes"))
    return rows.first().asDict()


def rows_dropped(spark: SparkSession, progress_path: str, query_id: str | None = None) -> int:
    """Late rows that watermarks dropped, of one query or all, from the stored progress (``progress.ProgressLog``), however long they ran."""
    rows = progress.read_progress(spark, progress_path)
    rows = rows if query_id is None else rows.where(F.col("query") == str(query_id))
    return int(rows.agg(F.coalesce(F.sum("rows_dropped"), F.lit(0))).first()[0])


@contextmanager
def state_partitions_of(spark: SparkSession, n: int | None):
    """Shuffle partitions, hence state stores, of a stream that starts within; Spark fixes them in its checkpoint."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    try:
        if n:
            spark.conf.set(key, str(n))
        yield
    finally:
        spark.conf.set(key, old)


def _post_columns() -> list:
    return [parse.whole_json() if c == "json" else c for c in parse.POST_COLUMNS]


def read_posts(spark: SparkSession, table_path: str) -> DataFrame:
    """Batch read of the posts in an ingest table (partition pruning on ``kind``)."""
    return (spark.read.schema(ENVELOPES_SCHEMA).parquet(table_path).where(F.col("kind") == "post")
            .select(*_post_columns(), "date"))


def read_rejects(spark: SparkSession, table_path: str) -> DataFrame:
    return (spark.read.schema(ENVELOPES_SCHEMA).parquet(table_path).where(F.col("kind") == "reject")
            .select(parse.whole_json().alias("line"), "reason", "error_title", "error_action"))


def drop_read(spark: SparkSession, table_path: str) -> None:
    """Deletes the rows of an ingest table, once every stream that reads it has committed them. Ingest and readers go on from their checkpoints:
    the sink's log still names the old files, so no row comes again. For tables kept for their readers alone; ``read_posts`` no longer works."""
    for kind in fs.names(spark, table_path, "kind="):
        fs.delete(spark, f"{table_path}/kind={kind}")


def posts_stream(spark: SparkSession, posts_path: str, watermark: str | None = None,
                 processing_time: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(ENVELOPES_SCHEMA).format("parquet").option("maxFileAge", NO_AGE_LIMIT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    fs.ensure_dir(spark, posts_path)
    df = r.load(posts_path).where(F.col("kind") == "post").select(*_post_columns())
    if processing_time:
        df = df.withColumn("created_ts", F.current_timestamp())
    if watermark:
        df = df.withWatermark("created_ts", watermark)
    return df


def start_metric(spark: SparkSession, posts_path: str, spec: M.MetricSpec, table_path: str, checkpoint: str,
                 watermark: str | None = None, available_now: bool = False, interval: str | None = None,
                 processing_time: bool = False, name: str | None = None, output_mode: str = "update",
                 max_files_per_trigger: int | None = None, state_partitions: int | None = None,
                 fold_every: int = hours.FOLD_EVERY) -> StreamingQuery:
    """A1-A7 (T1, T2, T4, T8, K3): windowed aggregate, upserted by key per batch; the stream folds its table every ``fold_every`` batches.

    ``output_mode="update"`` (default) sends only the buckets a batch changed; ``"complete"`` re-sends
    every bucket each trigger, as the reference did (state then never shrinks, watermark or not).
    Either way the sink replaces by key, so the table ends the same; read it with ``read_metric``."""
    grouped = M.windowed(posts_stream(spark, posts_path, watermark, processing_time, max_files_per_trigger), spec)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        run = fs.run_number(batch.sparkSession, table_path, checkpoint)
        hours.append(M.with_hour_key(batch, spec), table_path, epoch_id, run)
        hours.fold(batch.sparkSession, table_path, metric_keys(spec), every=fold_every)

    w = grouped.writeStream.outputMode(output_mode).foreachBatch(upsert).option("checkpointLocation", checkpoint)
    with state_partitions_of(spark, state_partitions):
        return trigger(w, available_now, interval or (None if available_now else spec.trigger), name).start()


def metric_keys(spec: M.MetricSpec) -> list[str]:
    return ["year", "month", "day", "hour", *spec.keys]


def read_metric(spark: SparkSession, table_path: str, spec: M.MetricSpec, between: tuple[str, str] | None = None) -> DataFrame | None:
    """The metric's present value of each key (of the dates ``between``), None before its first batch."""
    return hours.read(spark, table_path, metric_keys(spec), between=between)


def audit_state(spark: SparkSession, checkpoint: str, table_path: str, spec: M.MetricSpec) -> DataFrame:
    """What a metric's stream holds as state beside what its table says: (hour key, keys, in_state, in_table), by Spark's state reader.

    Without a watermark the two have the same keys and counts; with one the state lacks closed hours (in_state null). Counts only."""
    state = spark.read.format("statestore").load(checkpoint)
    held = state.select(*hour_key(F.col("key.window.start")), *[F.col(f"key.{k}").alias(k) for k in spec.keys], F.col("value.count").alias("in_state"))
    shown = read_metric(spark, table_path, spec).withColumnRenamed(spec.measure_name, "in_table")
    return held.join(shown, metric_keys(spec), "full")


def start_metric_merged(spark: SparkSession, posts_path: str, spec: M.MetricSpec, table_path: str, checkpoint: str, delay: str = "1 hour",
                        available_now: bool = False, interval: str | None = None, name: str | None = None,
                        max_files_per_trigger: int | None = None, fold_every: int = hours.FOLD_EVERY) -> StreamingQuery:
    """A1-A7 without state and without loss (T8): each batch is summed up by itself, and the table adds up the batches' sums.

    Nothing is held between batches but the watermark: the greatest time of the batches before less ``delay``, noted with each batch. What
    a batch adds to hours that ended before it goes apart as corrections (``hours.corrections``), is counted (``merged_totals``) and added once, when it is
    read as when it is folded. Read the metric with ``read_metric_merged``."""
    posts = posts_stream(spark, posts_path, max_files_per_trigger=max_files_per_trigger)
    sums = M.partial_columns(spec)
    wait = int(spark.sql(f"SELECT unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {delay})").first()[0])

    def add(batch: DataFrame, epoch_id: int) -> None:
        now = batch.sparkSession
        run = fs.run_number(now, table_path, checkpoint)
        last = hours.noted(now, table_path, run, epoch_id) or {"latest": None, "rows": 0, "late": 0}
        mark = None if last["latest"] is None else last["latest"] - wait
        parts = M.windowed_partials(batch, spec)
        # A sentinel before all time: nothing is late in the first batch.
        late = F.unix_micros("window.end") <= F.lit(-(1 << 62) if mark is None else mark)
        kept = parts.select(*hour_key(F.col("window.start")), *spec.keys, *sums, "_rows", "_latest", late.alias("_late"))
        hours.append(kept, table_path, epoch_id, run, late=F.col("_late"))
        rows, late_rows, latest = hours.batch_totals(now, table_path, epoch_id, run)
        known = [x for x in (last["latest"], latest) if x is not None]
        hours.note(now, table_path, run, epoch_id, {"latest": max(known, default=None), "rows": last["rows"] + rows, "late": last["late"] + late_rows})
        hours.fold(now, table_path, metric_keys(spec), sums, fold_every)

    w = posts.writeStream.outputMode("append").foreachBatch(add).option("checkpointLocation", checkpoint)
    return trigger(w, available_now, interval or (None if available_now else spec.trigger), name).start()


def read_metric_merged(spark: SparkSession, table_path: str, spec: M.MetricSpec, between: tuple[str, str] | None = None) -> DataFrame | None:
    """The value of each key from the sums of all batches (None before the first)."""
    added = hours.read(spark, table_path, metric_keys(spec), M.partial_columns(spec), between)
    return None if added is None else added.select(*metric_keys(spec), M.from_partials(spec))


def merged_totals(spark: SparkSession, table_path: str) -> dict | None:
    """Over all batches of the newest run: rows that were counted, how many came behind the watermark, the greatest time (microseconds)."""
    return hours.noted(spark, table_path)


def start_last_n(spark: SparkSession, posts_path: str, table_path: str, checkpoint: str,
                 available_now: bool = False, interval: str | None = None, name: str | None = None,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """A8 + K4 (T3): append stream of (party, id, created_ts) merged into the stored top-n per batch;
    read the result with ``sinks.tables.read_last_n``."""
    src = posts_stream(spark, posts_path, max_files_per_trigger=max_files_per_trigger).select("party", "id", "created_ts")

    def merge(batch: DataFrame, epoch_id: int) -> None:
        sinks.merge_last_n(batch, table_path, epoch_id, fs.run_number(batch.sparkSession, table_path, checkpoint))

    w = src.writeStream.outputMode("append").foreachBatch(merge).option("checkpointLocation", checkpoint)
    return trigger(w, available_now, interval, name).start()


def start_last_n_state(spark: SparkSession, posts_path: str, table_path: str, checkpoint: str, available_now: bool = False, interval: str | None = None,
                       name: str | None = None, max_files_per_trigger: int | None = None, n: int = lastn.LAST_N, every_ms: int | None = None,
                       state_partitions: int | None = None) -> StreamingQuery:
    """A8 + K4 by keyed state; read the table with ``read_last_n_state``."""
    lists = last_n_state(posts_stream(spark, posts_path, max_files_per_trigger=max_files_per_trigger), n, every_ms)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        sinks.upsert_by_key(batch, table_path, epoch_id, fs.run_number(batch.sparkSession, table_path, checkpoint))

    w = lists.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    with rocksdb(spark), state_partitions_of(spark, state_partitions):
        return trigger(w, available_now, interval, name).start()


def read_last_n_state(spark: SparkSession, table_path: str, n: int = lastn.LAST_N) -> DataFrame | None:
    """(scope, party, recency, id, ts), scope 'party' or 'combined'; None before the first batch."""
    stored = sinks.read_upserted(spark, table_path, ["party", "recency"])
    return None if stored is None else sinks.with_combined(stored, n)


def run_all(spark: SparkSession, source_dir: str, out_dir: str, watermark: str | None = None,
            available_now: bool = False, name_prefix: str = "", interval: str | None = None, strict: bool = False,
            max_files_per_trigger: int | None = None, processing_time: bool = False, output_mode: str = "update",
            replay: bool = False, state_partitions: int | None = None, spread: int | None = None, merged_delay: str | None = None,
            keyed_last_n: bool = False, fold_every: int = hours.FOLD_EVERY) -> dict[str, StreamingQuery]:
    """T5: the ingest query plus one query per metric and the last-n query, each checkpointed under
    ``out_dir/checkpoints``; every batch's progress is stored under ``out_dir/progress``. ``merged_delay``: metrics without state, late posts
    as corrections (read them with ``read_metric_merged``); ``keyed_last_n``: last n as keyed state (``read_last_n_state``). Triggers are each spec's refresh interval unless ``interval`` overrides
    them. Returns the handles by name; stop them with ``stop_all`` (T6)."""
    out = out_dir.rstrip("/")
    ck = f"{out}/checkpoints"
    progress.attach(spark, f"{out}/progress")
    handles = {"ingest": start_ingest(spark, source_dir, f"{out}/posts", f"{ck}/ingest",
                                      available_now=available_now, interval=interval, name=f"{name_prefix}ingest",
                                      max_files_per_trigger=max_files_per_trigger, strict=strict, replay=replay, spread=spread)}
    if available_now:
        handles["ingest"].awaitTermination()
    for spec in M.APP_SPECS:
        if merged_delay:
            handles[spec.name] = start_metric_merged(spark, f"{out}/posts", spec, f"{out}/{spec.name}", f"{ck}/{spec.name}", merged_delay, available_now,
                                                     interval, f"{name_prefix}{spec.name}", max_files_per_trigger, fold_every)
            continue
        handles[spec.name] = start_metric(spark, f"{out}/posts", spec, f"{out}/{spec.name}", f"{ck}/{spec.name}",
                                          watermark, available_now, interval, processing_time, f"{name_prefix}{spec.name}",
                                          output_mode, max_files_per_trigger, state_partitions, fold_every)
    start = start_last_n_state if keyed_last_n else start_last_n
    handles["last15"] = start(spark, f"{out}/posts", f"{out}/last15", f"{ck}/last15", available_now,
                              interval, name=f"{name_prefix}last15", max_files_per_trigger=max_files_per_trigger)
    return handles


def stop_all(spark: SparkSession) -> None:
    """Stops all queries, and the storing of their progress."""
    for q in spark.streams.active:
        q.stop()
    progress.detach_all()
