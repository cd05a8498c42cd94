"""Envelope and roster lines derived by Spark from the given tables.

The reference consumes JSON post envelopes and a ``;``-separated account roster. The test tables
hold neither, so these frames build them from ``events`` + ``documents`` and from ``customer``
(the mapping is the ``posts`` view of FIXTURES.md). Every line is built by Spark expressions from
every row of the tables, so the parse and everything after it grows with the data.

Which lines are broken is fixed by ``event_id`` (first match wins): ``% 29 = 0`` truncated JSON,
``% 23 = 0`` an error envelope, ``% 17 = 0`` a post without ``source`` (half of them with partial
errors beside it), ``% 31 = 0`` a post whose time can't be read. ``% 37 = 0`` has an empty text. Each post has
three rules (the second's tag counts, the third has none) and two users (the second is the author); every fifth is a reply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.functions.envelope import DISCONNECT_TITLE
from postwave.functions.timekeys import iso_millis_utc
from postwave.session import shuffles_dropped

# Fixed values of the fixture.
TRUNCATED_MOD, ERROR_MOD, NO_SOURCE_MOD = 29, 23, 17
BAD_TIME_MOD, EMPTY_TEXT_MOD = 31, 37
EARLY_TAG = "early"
OTHER_ERROR_TITLE = "stream-reset"
#: Lines of a landed file, which one task reads: small, so that a batch's files keep all cores busy to the end.
POSTS_PER_TASK = 5_000
#: Documents of a task at least, when posts are dealt to tasks by their document.
DOCS_PER_TASK = 16


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def posts_base(spark: SparkSession, sf_dir: str, turn: tuple[int, int] = (0, 1), cuts: list[int] | None = None, lot: int | None = None,
               parts: int | None = None) -> DataFrame:
    """events joined to their document: doc_id = event_id % N, N = number of documents.

    N is counted by a Spark job (from Parquet footers) and enters the plan as a literal. The join
    is an equi-join on the document key. Documents are hash-partitioned on ``doc_id`` first: that
    is the distribution a sort-merge join needs anyway (so at scale it adds no shuffle). The
    partition count comes from the number of events (one post each, 4 x ``POSTS_PER_TASK`` per task,
    at least the cluster's parallelism): each document row fans out to several posts that are then
    serialised, parsed and scored, so a byte-sized partitioning of the documents alone would put
    far too much CPU work in one task. When Spark broadcasts the small events side instead (under
    ``autoBroadcastJoinThreshold``), the post work still runs in that many tasks. ``turn`` (i, n): the posts of
    the i-th of n parts of the events (``cuts`` of ``time_cuts``: ranges of ``ts``, in order; else by a hash of the key). ``lot``:
    0 or 1, one half of the events by another hash of the key. ``parts``: the posts come in so many partitions, dealt by their documents:
    the texts are shuffled once, as documents, and the posts not again. Documents too few for that are dealt in copies.
    """
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    if lot is not None:
        events = events.where(F.pmod(F.xxhash64("event_id", F.lit("lot")), F.lit(2)) == lot)
    if turn[1] > 1:
        events = events.where(_turn_of(turn[1], cuts) == turn[0])
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    n_docs = docs.count()
    if parts is not None:
        copies = max(1, -(-parts * DOCS_PER_TASK // max(1, n_docs)))
        posts = events.withColumns({"_doc": F.col("event_id") % F.lit(n_docs), "_copy": F.pmod(F.xxhash64(*events.columns), F.lit(copies)).cast("int")})
        texts = docs.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        joined = posts.repartition(parts, "_doc", "_copy").join(
            texts.repartition(parts, "doc_id", "_copy"), (F.col("doc_id") == F.col("_doc")) & (posts["_copy"] == texts["_copy"]), "inner")
        return joined.drop("_doc", "_copy").withColumn("k", _k(F.col("props")))
    n_events = events.count()
    parts = max(spark.sparkContext.defaultParallelism, -(-n_events // (4 * POSTS_PER_TASK)))
    docs = docs.repartition(parts, "doc_id")
    joined = events.join(docs, docs["doc_id"] == (events["event_id"] % F.lit(n_docs)), "inner")
    return joined.withColumn("k", _k(F.col("props")))


def _micros() -> Column:
    return F.unix_micros(F.col("ts").cast("timestamp"))


def time_cuts(spark: SparkSession, sf_dir: str, n: int) -> list[int]:
    """Times (microseconds) that part the events into n ranges of about as many: approximate quantiles, one pass over ``ts``."""
    at = [i / n for i in range(1, n)]
    return read_table(spark, sf_dir, "events").agg(F.percentile_approx(_micros(), at, F.lit(max(1000, 100 * n)))).first()[0] or [] if at else []


def _turn_of(n: int, cuts: list[int] | None) -> Column:
    """0..n-1, never null: every event is in one turn; an event without a time is in the first of the ranges."""
    if cuts is None:
        return F.pmod(F.xxhash64("event_id"), F.lit(n))
    return sum((F.when(_micros() > cut, 1).otherwise(0) for cut in cuts), F.lit(0))


def _post_json(b: DataFrame) -> Column:
    eid = F.col("event_id")
    sid = eid.cast("string")
    uid = F.col("user_id").cast("string")
    k = F.col("k")
    n_att = k % 3
    n_tags = k % 4
    tag = lambda t: F.struct(F.lit(0).alias("start"), F.length(t).alias("end"), t.alias("tag"))
    tags = F.array(tag(F.concat(F.lit("t"), (k % 10).cast("string"))), tag(F.col("event_type")), tag(F.col("lang")))
    data = F.struct(
        sid.alias("id"),
        F.when(eid % EMPTY_TEXT_MOD == 0, F.lit("")).otherwise(F.col("text")).alias("text"),
        F.when(eid % BAD_TIME_MOD == 0, F.lit("yesterday")).otherwise(iso_millis_utc(F.col("ts"))).alias("created_at"),
        uid.alias("author_id"),
        F.when(eid % NO_SOURCE_MOD != 0, F.col("source")).alias("source"),
        F.when(n_att > 0, F.struct(
            F.array(F.concat(F.lit("3_"), sid)).alias("media_keys"),
            F.when(n_att > 1, F.array(F.concat(F.lit("p"), sid))).alias("poll_ids"))).alias("attachments"),
        F.when(n_tags > 0, F.struct(F.slice(tags, F.lit(1), n_tags).alias("hashtags"))).alias("entities"),
        F.when(k % 5 == 0, F.concat(F.lit("r"), uid)).alias("in_reply_to_user_id"),
    )
    user = F.struct(uid.alias("id"), F.concat(F.lit("user_"), uid).alias("username"),
                    F.concat(F.lit("User "), uid).alias("name"))
    other = F.struct(F.concat(F.lit("x"), uid).alias("id"), F.concat(F.lit("other_"), uid).alias("username"),
                     F.concat(F.lit("Other "), uid).alias("name"))
    rule = lambda n, tag: F.struct((F.lit(n) + (k % 7)).alias("id"), tag.alias("tag"))
    rules = F.array(rule(1000, F.lit(EARLY_TAG)), rule(2000, F.col("event_type")), rule(3000, F.lit(None).cast("string")))
    partial = F.when((eid % NO_SOURCE_MOD == 0) & (k % 2 == 0), F.array(F.struct(F.lit("Not Found Error").alias("title"))))
    return F.to_json(F.struct(data.alias("data"), F.struct(F.array(other, user).alias("users")).alias("includes"),
                              rules.alias("matching_rules"), partial.alias("errors")))


def _error_json(b: DataFrame) -> Column:
    title = F.when(F.col("k") % 2 == 0, F.lit(DISCONNECT_TITLE)).otherwise(F.lit(OTHER_ERROR_TITLE))
    err = F.struct(title.alias("title"), F.lit("UpstreamDisconnect").alias("disconnect_type"),
                   F.lit("The stream was disconnected.").alias("detail"),
                   F.concat(F.lit("problems/"), title).alias("type"))
    return F.to_json(F.struct(F.array(err).alias("errors")))


def envelope_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope line per event: ``event_id``, ``ts`` (for ordering files) and ``value``."""
    return _lines(posts_base(spark, sf_dir))


def _lines(b: DataFrame) -> DataFrame:
    post = _post_json(b)
    eid = F.col("event_id")
    value = (F.when(eid % TRUNCATED_MOD == 0, F.substring(post, 1, F.floor(F.length(post) / 2).cast("int")))
             .when(eid % ERROR_MOD == 0, _error_json(b))
             .otherwise(post))
    return b.select("event_id", "ts", value.alias("value"))


def file_count(spark: SparkSession, sf_dir: str, at_least: int, lot: int | None = None) -> int:
    """Files that the envelope lines (of a ``lot``: about half of them) land in: ``at_least``, or so many that one holds ``POSTS_PER_TASK`` lines or so,
    as a gzipped file is read by one task."""
    per_file = POSTS_PER_TASK if lot is None else 2 * POSTS_PER_TASK
    return max(at_least, -(-read_table(spark, sf_dir, "events").count() // per_file))


def land_envelope_files(spark: SparkSession, sf_dir: str, path: str, at_least: int, by_time: bool = True, lot: int | None = None,
                        turn: tuple[int, int] = (0, 1), cuts: list[int] | None = None) -> int:
    """Adds the envelope lines to folder ``path`` as gzipped text files (``file_count`` in all) and returns how many. Each holds one range
    of event time, or (not ``by_time``) lines in no order. Rows are dealt to files before their lines are made, so sampling for the ranges
    makes no line. Of several turns, which are read one after the other, each is the range of time, and its files are dealt by the documents. ``lot``: 0 or 1, the lines of that half of the events only. ``turn`` (i, n) and ``cuts``: the i-th of n parts of the events only
    (see ``posts_base``), so that neither all texts are shuffled at once nor all lines on the disk if the reader deletes what it has read."""
    files = -(-file_count(spark, sf_dir, at_least, lot) // turn[1])
    if turn[1] > 1:
        lines = _lines(posts_base(spark, sf_dir, turn, cuts, lot, files)).select("value")
    else:
        b = posts_base(spark, sf_dir, lot=lot)
        lines = _lines(b.repartitionByRange(files, "ts") if by_time else b.repartition(files)).select("value")
    with shuffles_dropped(spark):
        lines.write.mode("append").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)
    return files


def replay_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 input: each envelope wrapped as ``{_id, id, tweet: "<envelope>"}``."""
    env = envelope_lines(spark, sf_dir)
    sid = F.col("event_id").cast("string")
    wrapped = F.to_json(F.struct(F.struct(F.concat(F.lit("oid"), sid).alias("$oid")).alias("_id"),
                                 sid.alias("id"), F.col("value").alias("tweet")))
    return env.select("event_id", wrapped.alias("value"))


def roster_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 input built from ``customer`` (header lines are a matter of files): one row per customer (version 1), and a version 2
    that re-lists customers with a negative balance under party ``INDEPENDENT``. Rows of customers
    in nation 0 have only five cells (rejected by the loader).

    Columns: ``version`` (int) and ``value`` (the text line).
    """
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                                     "c_mktsegment")
    uid = F.col("c_custkey").cast("string")
    cells = lambda party: [F.concat(F.lit("\t "), F.col("c_name")), uid, F.col("c_name"), party,
                           F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")),
                           F.lit("2021-01-01 ")]
    six = F.concat_ws(";", *cells(F.col("c_mktsegment")))
    five = F.concat_ws(";", *cells(F.col("c_mktsegment"))[:5])
    v1 = c.select(F.lit(1).alias("version"),
                  F.when(F.col("c_nationkey") == 0, five).otherwise(six).alias("value"))
    v2 = c.where(F.col("c_acctbal") < 0).select(F.lit(2).alias("version"),
                                                F.concat_ws(";", *cells(F.lit("INDEPENDENT"))).alias("value"))
    return v1.unionByName(v2)


def land_roster_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Roster files with a header built from ``customer``: three files by c_custkey, each with three lines per customer (their
    parties end in 0, 1, 2) in the order of a digest."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    uid = F.col("c_custkey").cast("string")
    rows = c.select("*", F.explode(F.array(*[F.lit(v) for v in "012"])).alias("v")).select(
        (F.col("c_custkey") % 3).alias("file"), F.md5(F.concat_ws(":", uid, "v").cast("binary")).alias("order"),
        F.concat_ws(";", "c_name", uid, "c_name", F.concat_ws(" ", "c_mktsegment", "v"), F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")),
                    F.lit("2021-01-01")).alias("value"))
    placed = rows.repartition(3, "file").sortWithinPartitions("file", "order").select("file", "value")
    placed.write.partitionBy("file").option("header", True).option("sep", "\x01").option("quote", "").csv(path)
