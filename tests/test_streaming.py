import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from postwave.operators import metrics as M
from postwave.plans import catalog
from postwave.sinks import tables as sinks
from postwave.streaming import queries as SQ
from postwave.streaming.catalog import land_envelopes
from tests.conftest import SF_SMALL
from tests.envelopes import envelope


def write_lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


A3 = ["year", "month", "day", "hour", "party", "count"]


def test_stream_equals_batch(spark, tmp_dir):
    src = land_envelopes(spark, SF_SMALL, n_files=4)
    q = SQ.start_ingest(spark, src, f"{tmp_dir}/posts", f"{tmp_dir}/ck", available_now=True,
                        max_files_per_trigger=1)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p.numInputRows > 0]) == 4
    assert os.path.isdir(f"{tmp_dir}/posts/_spark_metadata")
    totals = SQ.ingest_counts(spark, f"{tmp_dir}/posts")
    counts = catalog.BATCH_QUERIES["ingest_counts"](spark, SF_SMALL).collect()[0].asDict()
    assert totals == counts
    m = SQ.start_metric(spark, f"{tmp_dir}/posts", M.POSTS_BY_HOUR_PARTY, f"{tmp_dir}/a3", f"{tmp_dir}/ck3",
                        available_now=True)
    m.awaitTermination()
    batch = catalog.BATCH_QUERIES["posts_by_hour_party"](spark, SF_SMALL)
    assert rows(SQ.read_metric(spark, f"{tmp_dir}/a3", M.POSTS_BY_HOUR_PARTY), A3) == rows(batch, A3)
    l15 = SQ.start_last_n(spark, f"{tmp_dir}/posts", f"{tmp_dir}/l15", f"{tmp_dir}/ckl", available_now=True)
    l15.awaitTermination()
    cols = ["party", "recency", "id"]
    assert rows(sinks.read_last_n(spark, f"{tmp_dir}/l15").where("scope = 'party'"), cols) == \
        rows(catalog.BATCH_QUERIES["last15_by_party"](spark, SF_SMALL), cols)
    rej = SQ.read_rejects(spark, f"{tmp_dir}/posts").groupBy("reason").count()
    assert rows(rej, ["reason", "count"]) == rows(
        catalog.BATCH_QUERIES["rejected_posts"](spark, SF_SMALL).withColumnRenamed("n", "count"), ["reason", "count"])


def _post(i, hour, minute=0, party="p"):
    return envelope(pid=str(i), created=f"2024-01-01T{hour:02d}:{minute:02d}:00.000Z", rules=[{"id": 1, "tag": party}])


def test_restart_and_late_rows(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", tmp_dir
    write_lines(src, "f1.txt", [_post(i, 10 + i % 3) for i in range(9)])       # hours 10, 11, 12

    def run():
        SQ.start_ingest(spark, src, f"{out}/posts", f"{out}/ck_i", available_now=True).awaitTermination()
        SQ.start_metric(spark, f"{out}/posts", M.POSTS_BY_HOUR_PARTY, f"{out}/a3", f"{out}/ck_m",
                        watermark="1 hour", available_now=True).awaitTermination()
        return {r["hour"]: r["count"] for r in SQ.read_metric(spark, f"{out}/a3", M.POSTS_BY_HOUR_PARTY).collect()}

    assert run() == {10: 3, 11: 3, 12: 3}
    # restart from the same checkpoints with more rows: an open hour (12), a row inside the
    # watermark (11:30, watermark is 12:00 - 1 h = 11:00) and one beyond it (09:00, dropped)
    write_lines(src, "f2.txt", [_post(100, 12, 5), _post(101, 11, 30), _post(102, 9, 0)])
    assert run() == {10: 3, 11: 4, 12: 4}
    # the same files again change nothing (the file source remembers them in its checkpoint)
    assert run() == {10: 3, 11: 4, 12: 4}


KEYS = ["year", "month", "day", "hour", "party"]
ROW = "year int, month int, day int, hour int, party string, count long"


def test_upsert_batch_is_idempotent_and_compacts(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    b1 = spark.createDataFrame([(2024, 1, 1, 1, "a", 5), (2024, 1, 2, 3, "a", 1)], ROW)
    b2 = spark.createDataFrame([(2024, 1, 1, 1, "a", 7), (2024, 1, 1, 2, "b", 2)], ROW)
    assert sinks.read_upserted(spark, path, KEYS) is None
    sinks.upsert_by_key(b1, path, 0)
    sinks.upsert_by_key(b2, path, 1)
    want = [(2024, 1, 1, 1, "a", 7), (2024, 1, 1, 2, "b", 2), (2024, 1, 2, 3, "a", 1)]
    assert rows(sinks.read_upserted(spark, path, KEYS), A3) == want
    sinks.upsert_by_key(b2, path, 1)              # the batch runs again after a failure
    os.makedirs(f"{path}/run=0/epoch=2")            # a batch that died leaves a folder without _SUCCESS
    assert rows(sinks.read_upserted(spark, path, KEYS), A3) == want
    for epoch in range(2, 14):
        sinks.upsert_by_key(spark.createDataFrame([(2024, 1, 1, 1, "a", 100 + epoch)], ROW), path, epoch)
        if epoch % 4 == 1:
            sinks.compact(spark, path, KEYS)
        assert dict((r["hour"], r["count"]) for r in sinks.read_upserted(spark, path, KEYS).where("day = 1").collect()) == {1: 100 + epoch, 2: 2}
    assert sorted(os.listdir(path)) == ["base=0.13", "base=0.9", "run=0"] and len(os.listdir(f"{path}/run=0")) <= 4
    # a later run goes before all batches of an earlier one
    sinks.upsert_by_key(spark.createDataFrame([(2024, 1, 1, 1, "a", 3)], ROW), path, 0, run=1)
    assert rows(sinks.read_upserted(spark, path, KEYS), A3)[0][-1] == 3


def test_new_checkpoint_on_an_old_table(spark, tmp_dir):
    src, out, spec = f"{tmp_dir}/in", tmp_dir, M.POSTS_BY_HOUR_PARTY

    def land(name, posts):
        write_lines(src, name, posts)
        SQ.start_ingest(spark, src, f"{out}/posts", f"{out}/ck_i", available_now=True).awaitTermination()

    def metric(ck):
        SQ.start_metric(spark, f"{out}/posts", spec, f"{out}/a3", f"{out}/{ck}", available_now=True).awaitTermination()
        return {r["hour"]: r["count"] for r in SQ.read_metric(spark, f"{out}/a3", spec).collect()}

    def last(ck):
        SQ.start_last_n(spark, f"{out}/posts", f"{out}/l15", f"{out}/{ck}l", available_now=True).awaitTermination()
        return [r["id"] for r in sinks.read_last_n(spark, f"{out}/l15").where("scope = 'combined'").orderBy("recency").collect()]

    land("f1.txt", [_post(i, 10) for i in range(5)])
    assert metric("c1") == {10: 5} and last("c1") == ["4", "3", "2", "1", "0"]
    land("f2.txt", [_post(10 + i, 10 + i % 2, 30) for i in range(7)])
    assert metric("c2") == {10: 9, 11: 3}           # first start of a new checkpoint: all posts
    assert last("c2")[:2] == ["15", "13"]
    land("f3.txt", [_post(30, 12), _post(31, 10)])
    assert metric("c2") == {10: 10, 11: 3, 12: 1}
    assert last("c2")[0] == "30" and len(last("c2")) == 14


def test_batch_that_died_after_its_write_runs_again(spark, tmp_dir):
    """The commit of the last batch is taken back, as if the driver had died between write and commit."""
    src, out, spec = f"{tmp_dir}/in", tmp_dir, M.POSTS_BY_HOUR_PARTY
    write_lines(src, "f1.txt", [_post(i, 10) for i in range(5)])
    SQ.start_ingest(spark, src, f"{out}/posts", f"{out}/ck_i", available_now=True).awaitTermination()
    for _ in range(2):
        SQ.start_metric(spark, f"{out}/posts", spec, f"{out}/a3", f"{out}/ck", available_now=True).awaitTermination()
        assert [r["count"] for r in SQ.read_metric(spark, f"{out}/a3", spec).collect()] == [5]
        for name in os.listdir(f"{out}/ck/commits"):
            if name.lstrip(".").startswith("0"):
                os.remove(f"{out}/ck/commits/{name}")


def test_late_posts_of_throttled_batches_count(spark, tmp_dir):
    src, out, spec = f"{tmp_dir}/in", tmp_dir, M.POSTS_BY_HOUR_PARTY
    for f in range(4):                              # newest hours first
        write_lines(src, f"f{f}.txt", [_post(100 * f + i, 20 - 5 * f) for i in range(6)] + [envelope(pid=f"b{f}", created="10.30 Uhr")])
    SQ.start_ingest(spark, src, f"{out}/posts", f"{out}/ck_i", available_now=True, max_files_per_trigger=1).awaitTermination()
    q = SQ.start_metric(spark, f"{out}/posts", spec, f"{out}/a3", f"{out}/ck", available_now=True, max_files_per_trigger=1)
    q.awaitTermination()
    counts = SQ.ingest_counts(spark, f"{out}/posts")
    counted = SQ.read_metric(spark, f"{out}/a3", spec).agg(F.sum("count")).first()[0]
    assert counts == {"lines": 28, "valid": 24, "rejected": 4, "error_envelopes": 0} and counted == 24


def test_replay_lines_and_processing_time_in_the_application(spark, tmp_dir):
    import json
    src = f"{tmp_dir}/in"
    write_lines(src, "r.txt", [json.dumps({"id": str(i), "tweet": _post(i, 4)}) for i in range(6)] + ["", "{broken"])
    handles = SQ.run_all(spark, src, f"{tmp_dir}/out", available_now=True, replay=True, processing_time=True, max_files_per_trigger=2,
                         state_partitions=3, output_mode="complete")
    for h in handles.values():
        h.awaitTermination()
    got = SQ.read_metric(spark, f"{tmp_dir}/out/posts_by_hour_party", M.POSTS_BY_HOUR_PARTY).collect()
    assert sum(r["count"] for r in got) == 6 and all(r["year"] >= 2025 for r in got)
    assert len([d for d in os.listdir(f"{tmp_dir}/out/checkpoints/posts_by_hour_party/state/0") if d.isdigit()]) == 3


def test_files_per_kind_and_date_are_bounded(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    for f in range(6):
        write_lines(src, f"f{f}.txt", [envelope(pid=f"{f}-{d}-{i}", created=f"2024-01-{d:02d}T01:00:00Z") for d in range(1, 6) for i in range(9)])
    SQ.start_ingest(spark, src, f"{tmp_dir}/posts", f"{tmp_dir}/ck", available_now=True, spread=2).awaitTermination()
    for d in range(1, 6):
        files = os.listdir(f"{tmp_dir}/posts/kind=post/date=2024-01-{d:02d}")
        assert len([f for f in files if f.endswith(".parquet")]) <= 2


def test_a_hot_date_is_written_by_many_tasks_and_small_ones_by_few(spark, tmp_dir):
    src, conf = f"{tmp_dir}/in", {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2"}
    for f in range(8):
        write_lines(src, f"f{f}.txt", [envelope(pid=f"{f}-{i}", created="2024-01-01T01:00:00Z", text=f"{f * 7919 + i * 104729} " * 60) for i in range(300)]
                    + [envelope(pid=f"{f}-{i}b", created=f"2024-02-{i + 1:02d}T01:00:00Z") for i in range(5)])
    old = {k: spark.conf.get(k, None) for k in (*conf, "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k, v in {**conf, "spark.sql.files.maxPartitionBytes": "200000", "spark.sql.files.openCostInBytes": "100000"}.items():
            spark.conf.set(k, v)
        SQ.start_ingest(spark, src, f"{tmp_dir}/posts", f"{tmp_dir}/ck", available_now=True).awaitTermination()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    count = lambda d: len([f for f in os.listdir(f"{tmp_dir}/posts/kind=post/date={d}") if f.endswith(".parquet")])
    assert count("2024-01-01") >= 6 and all(count(f"2024-02-{d:02d}") <= 2 for d in range(1, 6))


def test_processing_time_mode(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    write_lines(src, "f1.txt", [_post(i, 3) for i in range(4)])
    SQ.start_ingest(spark, src, f"{tmp_dir}/posts", f"{tmp_dir}/ck_i", available_now=True).awaitTermination()
    SQ.start_metric(spark, f"{tmp_dir}/posts", M.POSTS_BY_HOUR_PARTY, f"{tmp_dir}/a3", f"{tmp_dir}/ck_m",
                    watermark=None, available_now=True, processing_time=True).awaitTermination()
    got = SQ.read_metric(spark, f"{tmp_dir}/a3", M.POSTS_BY_HOUR_PARTY).collect()
    assert sum(r["count"] for r in got) == 4 and all(r["year"] >= 2025 for r in got)


def test_run_all_and_stop(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    write_lines(src, "f1.txt", [_post(i, 1 + i % 2, party="p" + str(i % 3)) for i in range(12)])
    handles = SQ.run_all(spark, src, f"{tmp_dir}/out", watermark="1 hour", available_now=True)
    for h in handles.values():
        h.awaitTermination()
    SQ.stop_all(spark)
    assert not spark.streams.active
    assert SQ.read_metric(spark, f"{tmp_dir}/out/posts_by_hour_party", M.POSTS_BY_HOUR_PARTY).agg(F.sum("count")).collect()[0][0] == 12
    assert sinks.read_last_n(spark, f"{tmp_dir}/out/last15").where("scope = 'combined'").count() == 12


def test_rocksdb_state_store(spark, tmp_dir):
    from postwave.session import cluster_conf
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    src = f"{tmp_dir}/in"
    write_lines(src, "f1.txt", [_post(i, 4 + i % 2) for i in range(6)])
    try:
        spark.conf.set(key, cluster_conf()[key])
        SQ.start_ingest(spark, src, f"{tmp_dir}/posts", f"{tmp_dir}/ck_i", available_now=True).awaitTermination()
        SQ.start_metric(spark, f"{tmp_dir}/posts", M.POSTS_BY_HOUR_PARTY, f"{tmp_dir}/a3", f"{tmp_dir}/ck_m",
                        watermark="1 hour", available_now=True).awaitTermination()
    finally:
        spark.conf.set(key, old)
    assert {r["hour"]: r["count"] for r in SQ.read_metric(spark, f"{tmp_dir}/a3", M.POSTS_BY_HOUR_PARTY).collect()} == {4: 3, 5: 3}


def test_run_all_continuous(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    handles = SQ.run_all(spark, src, f"{tmp_dir}/out", watermark="1 hour", name_prefix="t_", interval="1 second")
    try:
        assert {q.name for q in spark.streams.active} >= {"t_ingest", "t_posts_by_hour_party", "t_last15"}
        write_lines(src, "a.txt", [_post(i, i % 3) for i in range(9)])
        handles["ingest"].processAllAvailable()
        for name in ("posts_by_hour_party", "last15"):
            handles[name].processAllAvailable()
        got = {r["hour"]: r["count"] for r in SQ.read_metric(spark, f"{tmp_dir}/out/posts_by_hour_party", M.POSTS_BY_HOUR_PARTY).collect()}
        assert got == {0: 3, 1: 3, 2: 3}
        assert all(q.exception() is None for q in handles.values())
    finally:
        SQ.stop_all(spark)


def test_complete_mode_same_table(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    write_lines(src, "f1.txt", [_post(i, i % 4, party="p" + str(i % 2)) for i in range(12)])
    SQ.start_ingest(spark, src, f"{tmp_dir}/posts", f"{tmp_dir}/ck_i", available_now=True).awaitTermination()
    out = {}
    for mode in ("update", "complete"):
        SQ.start_metric(spark, f"{tmp_dir}/posts", M.SOURCE_BY_HOUR_PARTY, f"{tmp_dir}/{mode}",
                        f"{tmp_dir}/ck_{mode}", watermark=None, available_now=True,
                        output_mode=mode).awaitTermination()
        out[mode] = rows(SQ.read_metric(spark, f"{tmp_dir}/{mode}", M.SOURCE_BY_HOUR_PARTY), ["year", "month", "day", "hour", "party",
                                                                    "source", "count"])
    assert out["update"] == out["complete"] and sum(r[-1] for r in out["update"]) == 12


def test_last_n_survives_a_failed_batch_and_keeps_repeated_posts(spark, tmp_dir):
    schema = "party string, id string, created_ts timestamp"
    t = lambda s: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)
    path = f"{tmp_dir}/l15"
    whole = []
    for epoch in range(5):
        some = [("p", str(epoch * 10 + i), t(epoch * 10 + i)) for i in range(10)] + [("p", "3", t(3)), ("q", str(epoch), t(100))]
        whole += some
        sinks.merge_last_n(spark.createDataFrame(some, schema), path, epoch)
    os.makedirs(f"{path}/run=0/epoch=5")             # a batch that died leaves a folder without _SUCCESS
    more = [("p", "50", t(50)), ("p", "50", t(50)), ("p", "49", t(49))]
    for _ in range(2):                              # batch 5 runs, and runs again
        sinks.merge_last_n(spark.createDataFrame(more, schema), path, 5)
        from postwave.operators import lastn
        batch = spark.createDataFrame(whole + more, schema)
        got = sinks.read_last_n(spark, path)
        cols = ["party", "recency", "id"]
        assert rows(got.where("scope = 'party'"), cols) == rows(lastn.last_n_by_party(batch), cols)
        assert rows(got.where("scope = 'combined'"), cols[1:]) == rows(lastn.last_n_combined(batch), cols[1:])
    assert sorted(os.listdir(f"{path}/run=0")) == ["epoch=3", "epoch=4", "epoch=5"]


def test_ingest_holds_little_disk(spark, tmp_dir, monkeypatch):
    """Lines land gzipped, in more files if there are more; files that ingest has read go, and so do its shuffles."""
    from postwave.session import shuffles_dropped
    from postwave.sources import tables

    spark.createDataFrame([(i, dt.datetime(2024, 1, 1, i % 24), 7, "view", '{"k": 3}') for i in range(60)],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, props string").write.parquet(f"{tmp_dir}/events.parquet")
    spark.createDataFrame([(i, "good text " * 50, "en", "web") for i in range(5)], "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_dir}/documents.parquet")
    monkeypatch.setattr(tables, "POSTS_PER_TASK", 6)
    src, whole = f"{tmp_dir}/in", sorted(r.value for r in tables.envelope_lines(spark, tmp_dir).collect())
    assert tables.land_envelope_files(spark, tmp_dir, src, 4) == 10
    landed = [f for f in os.listdir(src) if f.endswith(".txt.gz")]
    assert 8 <= len(landed) <= 10 and not [f for f in os.listdir(src) if f.endswith(".txt")]
    assert sorted(r.value for r in spark.read.text(src).collect()) == whole
    for lot in (0, 1):
        tables.land_envelope_files(spark, tmp_dir, f"{tmp_dir}/lots", 2, by_time=False, lot=lot)
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/lots").collect()) == whole

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with shuffles_dropped(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == before
    SQ.start_ingest(spark, src, f"{tmp_dir}/posts", f"{tmp_dir}/ck", available_now=True, max_files_per_trigger=2, consume=True).awaitTermination()
    assert len([f for f in os.listdir(src) if f.endswith(".gz")]) <= 2            # the last batch's, whose turn would come with the next
    assert SQ.ingest_counts(spark, f"{tmp_dir}/posts")["lines"] == 60
    written = [f for _, _, files in os.walk(f"{tmp_dir}/posts") for f in files if f.endswith(".parquet")]
    assert written and all(f.endswith(".zstd.parquet") for f in written)


@pytest.mark.parametrize("by_time", [True, False])
def test_lines_land_in_turns(spark, tmp_dir, monkeypatch, by_time):
    """Many lines land part by part, each deleted when it has been read: the folder never holds more than a turn's, and no line is lost or comes twice."""
    from postwave.sources import tables
    from postwave.streaming import catalog as streams

    events = [(i, None if i % 20 == 0 else dt.datetime(2024, 1, 1, i % 24, i), 7, "view", '{"k": 3}') for i in range(58)]
    events += [events[5], (None, dt.datetime(2024, 1, 1), 7, "view", '{"k": 3}')]           # a key twice, one null: it has no document
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string").write.parquet(f"{tmp_dir}/events.parquet")
    spark.createDataFrame([(i, f"good text {i}", "en", "web") for i in range(5)], "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_dir}/documents.parquet")
    monkeypatch.setattr(tables, "POSTS_PER_TASK", 6)
    monkeypatch.setattr(streams, "FILES_PER_BATCH", 3)
    whole = sorted(r.value for r in tables.envelope_lines(spark, tmp_dir).collect())
    src, out, turns, spans = f"{tmp_dir}/in", f"{tmp_dir}/out", [], []
    for files in streams._landed(spark, tmp_dir, src, 4, by_time):
        assert files == 10 and 0 < len([f for f in os.listdir(src) if f.endswith(".gz")]) <= 3
        turns.append([r.value for r in spark.read.text(src).collect()])
        times = sorted(t for t in (json.loads(v).get("data", {}).get("created_at", "") for v in turns[-1] if v.endswith("}")) if t.startswith("2024"))
        spans.append((times[0], times[-1]))
        streams._ingest(spark, src, out, 2)
    assert len(turns) == 4 and max(map(len, turns)) < 30 and sorted(v for t in turns for v in t) == whole
    if by_time:
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert os.listdir(src) == [] and SQ.ingest_counts(spark, f"{out}/posts")["lines"] == len(whole) == 59
    want = rows(catalog.posts(spark, tmp_dir).select("id", "createdDate"), ["id", "createdDate"])
    assert rows(SQ.read_posts(spark, f"{out}/posts").select("id", "createdDate"), ["id", "createdDate"]) == want


def test_table_holds_each_text_once(spark, tmp_dir):
    """The ingest table stores a line's text once and gives back every line as it was, however its text is escaped."""
    src, texts = f"{tmp_dir}/in", ["", "plain [words]", 'quo"te \\ and / slash', "tab\tline\nend", "grün € \U0001f600  ", "]", '"', "id", "a" * 5000]
    made = [envelope(pid=str(i), text=t, created="2024-01-01T10:00:00.000Z") for i, t in enumerate(texts)]             # \u escapes
    plain = [json.dumps(json.loads(v), ensure_ascii=False, separators=(",", ":")).replace('"id":"', '"id":"1', 1) for v in made]
    slashes = [plain[2].replace("/", "\\/").replace('"id":"1', '"id":"2', 1)]
    broken = [plain[1][:60], "{}", json.dumps({"errors": [{"title": "x"}]})]
    write_lines(src, "f.txt", made + plain + slashes + broken)
    for spread in (None, 2):
        table = f"{tmp_dir}/posts{spread}"
        SQ.start_ingest(spark, src, table, f"{tmp_dir}/ck{spread}", available_now=True, spread=spread).awaitTermination()
        posts = SQ.read_posts(spark, table)
        assert sorted(r.json for r in posts.collect()) == sorted(made + plain + slashes)
        assert {(r.json, r.text) for r in posts.collect()} == {(v, json.loads(v)["data"]["text"]) for v in made + plain + slashes}
        assert sorted(r.line for r in SQ.read_rejects(spark, table).collect()) == sorted(broken)
        stored = spark.read.parquet(table).where("kind = 'post'")
        assert stored.where("json is null").count() >= len(plain)
        assert stored.where("text like 'aaa%' and (json like '%aaa%' or json_before like '%aaa%' or json_after like '%aaa%')").count() == 0


@pytest.mark.parametrize("name", ["posts_by_hour", "last15", "progress", "state_audit"])
def test_posts_go_after_each_turn(spark, tmp_dir, monkeypatch, name):
    """Over several turns the posts on the disk are a turn's at most, and the result is that of one turn."""
    from postwave.sources import tables
    from postwave.streaming import catalog as streams

    events = [(i, dt.datetime(2024, 1, 1, i % 24, i), 7, "view" if i % 3 else "buy", '{"k": 3}') for i in range(58)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string").write.parquet(f"{tmp_dir}/events.parquet")
    spark.createDataFrame([(i, f"good text {i}", "en", "web") for i in range(5)], "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_dir}/documents.parquet")
    query = streams.STREAM_QUERIES[f"stream_{name}"]
    one = sorted(map(tuple, query(spark, tmp_dir).collect()), key=str)
    monkeypatch.setattr(tables, "POSTS_PER_TASK", 10)
    monkeypatch.setattr(streams, "FILES_PER_BATCH", 5)
    held, drop = [], SQ.drop_read

    def drop_read(spark, path):
        held.append(sum(f.endswith(".parquet") for _, _, files in os.walk(path.removeprefix("file:")) for f in files))
        drop(spark, path)
        assert not [n for n in os.listdir(path.removeprefix("file:")) if n.startswith("kind=")]
    monkeypatch.setattr(SQ, "drop_read", drop_read)
    assert sorted(map(tuple, query(spark, tmp_dir).collect()), key=str) == one and one
    assert len([n for n in held if n]) >= 2


@pytest.mark.parametrize("lot", [None, 0])
def test_turns_grow_in_number_not_in_size(spark, tmp_dir, monkeypatch, lot):
    """More events make more turns: each holds a batch of files, beyond eight turns too, and a lot takes half of the events before their texts are shuffled."""
    from postwave.sources import tables
    from postwave.streaming import catalog as streams

    events = [(i, dt.datetime(2024, 1, 1, i % 24, i % 60, i // 60), 7, "view", '{"k": 3}') for i in range(200)] + [(None, None, 7, "view", '{"k": 3}')]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string").write.parquet(f"{tmp_dir}/events.parquet")
    spark.createDataFrame([(i, f"good text {i}", "en", "web") for i in range(7)], "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_dir}/documents.parquet")
    monkeypatch.setattr(tables, "POSTS_PER_TASK", 2 if lot is None else 1)
    monkeypatch.setattr(streams, "FILES_PER_BATCH", 10)
    whole = sorted(r.value for r in tables.envelope_lines(spark, tmp_dir).collect())
    sizes, lines = [], []
    for _ in streams._landed(spark, tmp_dir, f"{tmp_dir}/in", 8, by_time=lot is None, lot=lot):
        lines += [r.value for r in spark.read.text(f"{tmp_dir}/in").collect()]
        sizes.append(len(lines) - sum(sizes))
    assert len(sizes) == 11 and sum(sizes) == len(lines)
    if lot is None:
        assert sorted(lines) == whole and max(sizes) <= 30
    else:
        held = [tables.posts_base(spark, tmp_dir, lot=v).count() for v in (0, 1)]
        assert held[0] == len(lines) and sum(held) == len(whole) and min(held) > 60
        tables.land_envelope_files(spark, tmp_dir, f"{tmp_dir}/in", 2, by_time=False, lot=1)
        assert sorted(lines + [r.value for r in spark.read.text(f"{tmp_dir}/in").collect()]) == whole


@pytest.mark.parametrize("docs", [5, 40])
def test_next_turn_lands_beside_and_texts_are_shuffled_once(spark, tmp_dir, monkeypatch, docs):
    """While a turn is read the next one lands beside it; of several turns the posts are dealt with their documents, and not shuffled again to be written."""
    import time

    from postwave.sources import tables
    from postwave.streaming import catalog as streams

    events = [(i, dt.datetime(2024, 1, 1, i % 24, i), 7, "view", '{"k": 3}') for i in range(58)]
    events += [events[5], (None, dt.datetime(2024, 1, 1), 7, "view", '{"k": 3}'), (70, None, None, None, None)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string").write.parquet(f"{tmp_dir}/events.parquet")
    texts = [(i % docs, f"good text {i}", "en", "web") for i in range(docs + 1)]             # one document twice
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_dir}/documents.parquet")
    cols = ["event_id", "doc_id", "text", "ts", "k"]
    dealt = tables.posts_base(spark, tmp_dir, parts=4)
    assert sorted(map(str, rows(dealt, cols))) == sorted(map(str, rows(tables.posts_base(spark, tmp_dir), cols)))
    in_part = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(in_part) == 4 and max(in_part) < 40                                          # five documents don't make it fewer
    plan = tables._lines(dealt)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "RoundRobinPartitioning" not in plan and plan.count("Exchange hashpartitioning") <= 2

    monkeypatch.setattr(tables, "POSTS_PER_TASK", 6)
    monkeypatch.setattr(streams, "FILES_PER_BATCH", 4)
    src, beside, got = f"{tmp_dir}/in", 0, []
    for i, _ in enumerate(streams._landed(spark, tmp_dir, src, 4)):
        until = time.monotonic() + 20
        while i < 2 and not os.path.exists(f"{src}-next-None-{i + 1}/_SUCCESS") and time.monotonic() < until:
            time.sleep(0.1)
        beside += os.path.exists(f"{src}-next-None-{i + 1}/_SUCCESS")
        got += [r.value for r in spark.read.text(src).collect()]
    assert beside == 2 and sorted(got) == sorted(r.value for r in tables.envelope_lines(spark, tmp_dir).collect())
    assert not [n for n in os.listdir(tmp_dir) if n.startswith("in-next")] and os.listdir(src) == []
