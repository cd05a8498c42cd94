"""Hourly metric tables: folding by the stream, reading of single dates, corrections without loss, stored progress."""

import os
import random

from pyspark.sql import functions as F

from postwave.operators import metrics as M
from postwave.sinks import hours
from postwave.streaming import progress
from postwave.streaming import queries as SQ
from tests.test_streaming import _post, envelope, rows, write_lines

KEYS = ["year", "month", "day", "hour", "party"]
ROW = "year int, month int, day int, hour int, party string, count long"


def folders(path):
    return sum(len(dirs) for _, dirs, _ in os.walk(path))


def test_two_hundred_batches_stay_few_folders_and_one_hour_opens_its_files(spark, tmp_dir):
    path, rnd, want, most = f"{tmp_dir}/t", random.Random(1), {}, 0
    assert hours.read(spark, path, KEYS) is None
    for epoch in range(200):
        some = {(2024, 1, 1 + epoch // 40, rnd.randrange(24), rnd.choice("ab")): epoch * 10 + i for i in range(3)}
        want |= some
        hours.append(spark.createDataFrame([(*k, v) for k, v in some.items()], ROW).coalesce(1), path, epoch)
        hours.fold(spark, path, KEYS, every=10)
        most = max(most, folders(path))
        if epoch in (4, 57, 123):
            assert sorted((*r[:5], r[5]) for r in hours.read(spark, path, KEYS).collect()) == sorted((*k, v) for k, v in want.items())
    assert most < 110
    got = hours.read(spark, path, KEYS)
    assert sorted(tuple(r) for r in got.collect()) == sorted((*k, v) for k, v in want.items())
    one = hours.read(spark, path, KEYS, between=("2024-01-02", "2024-01-02")).where("hour = 3")
    assert {f.split("date=")[1][:10] for f in one.inputFiles()} == {"2024-01-02"}
    assert sorted(tuple(r) for r in one.collect()) == sorted((*k, v) for k, v in want.items() if k[2] == 2 and k[3] == 3)
    # a batch that runs again after it was folded changes nothing; a later run replaces
    hours.append(spark.createDataFrame([(2024, 1, 5, 1, "a", -1)], ROW), path, 199)
    assert hours.read(spark, path, KEYS).where("count < 0").count() == 0
    hours.append(spark.createDataFrame([(2024, 1, 5, 1, "a", -1)], ROW), path, 0, run=1)
    assert hours.read(spark, path, KEYS).where("count < 0").count() == 1


def test_added_rows_are_counted_once(spark, tmp_dir):
    path, schema = f"{tmp_dir}/t", "year int, month int, day int, hour int, party string, _n long, _s double"
    for again in (0, 1):
        for epoch in range(7):
            if again and epoch < 5:
                continue                            # the last batches run again after a restart
            batch = spark.createDataFrame([(2024, 1, 1 + epoch % 2, 5, "a", 1, 0.5), (2024, 1, 1, 6, "b", epoch, 1.0)], schema)
            hours.append(batch, path, epoch, late=F.col("party") == "b")
            hours.fold(spark, path, KEYS, ["_n", "_s"], every=3)
            read = hours.read(spark, path, KEYS, ["_n", "_s"])
            n = 7 if again else epoch + 1
            assert read.agg(F.sum("_s")).first()[0] == 1.5 * n
            assert read.where("party = 'b'").first()["_n"] == sum(range(n))
    assert [r["_n"] for r in hours.corrections(spark, path).collect()] == [6]
    # a new query counts all posts again, so its rows take the place of the older run's
    hours.append(spark.createDataFrame([(2024, 1, 1, 6, "b", 100, 2.0)], schema), path, 0, run=1)
    assert hours.read(spark, path, KEYS, ["_n", "_s"]).where("party = 'b'").first()["_n"] == 100


def test_late_posts_are_added_as_corrections(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", tmp_dir
    specs = (M.POSTS_BY_HOUR_PARTY, M.SENTIMENT_BY_HOUR_PARTY, M.SCORED_SENTIMENT_BY_HOUR_PARTY)
    for lot in range(2):                            # the second lot comes after a restart
        for f in range(3):                          # newest hours first
            write_lines(src, f"f{lot}{f}.txt", [_post(100 * f + 10 * lot + i, 20 - 5 * f + i % 2, party="pq"[i % 2]) for i in range(6)])
            SQ.start_ingest(spark, src, f"{out}/posts", f"{out}/ck_i", available_now=True).awaitTermination()
        for spec in specs:
            SQ.start_metric_merged(spark, f"{out}/posts", spec, f"{out}/{spec.name}", f"{out}/ck_{spec.name}", "1 hour", available_now=True,
                                   max_files_per_trigger=1, fold_every=2).awaitTermination()
    posts = SQ.read_posts(spark, f"{out}/posts")
    for spec in specs:
        cols = [*SQ.metric_keys(spec), spec.measure_name]
        assert rows(SQ.read_metric_merged(spark, f"{out}/{spec.name}", spec), cols) == rows(M.metric_from_spec(posts, spec), cols)
    got = SQ.merged_totals(spark, f"{out}/posts_by_hour_party")
    assert got["rows"] == 36 and 18 <= got["late"] < 36


def test_progress_outlives_the_reports_that_spark_keeps(spark, tmp_dir):
    src, out, key = f"{tmp_dir}/in", tmp_dir, "spark.sql.streaming.numRecentProgressUpdates"
    old = spark.conf.get(key)
    spark.conf.set(key, "5")
    log = progress.ProgressLog(spark, f"{out}/progress", fold_every=12).attach()
    try:
        for lot in range(2):
            for f in range(15):
                write_lines(src, f"f{lot}{f:02d}.txt", [_post(100 * f + i, 23 - f) for i in range(2)] + [envelope(pid=f"b{f}", created="10.30 Uhr")])
            q = SQ.start_ingest(spark, src, f"{out}/posts", f"{out}/ck_i", available_now=True, max_files_per_trigger=1, name="ingest")
            q.awaitTermination()
        assert len(q.recentProgress) <= 5
        w = SQ.start_metric(spark, f"{out}/posts", M.POSTS_BY_HOUR_PARTY, f"{out}/w", f"{out}/ck_w", watermark="1 hour", available_now=True, max_files_per_trigger=2)
        w.awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
        import time
        for _ in range(50):                         # reports reach Python on their own thread
            if progress.totals(spark, f"{out}/progress").where(F.col("query") == str(w.id)).where("batches > 0").count():
                break
            time.sleep(0.2)
        got = {r["query"]: r for r in progress.totals(spark, f"{out}/progress").collect()}
        ingest = got[str(q.id)]
        assert (ingest["batches"], ingest["lines"], ingest["valid"], ingest["rejected"], ingest["failed"]) == (30, 90, 60, 30, 0)
        counted = SQ.read_metric(spark, f"{out}/w", M.POSTS_BY_HOUR_PARTY).agg(F.sum("count")).first()[0]
        assert counted < 60 and SQ.rows_dropped(spark, f"{out}/progress", w.id) > 0
        files = os.listdir(f"{out}/progress/query={q.id}")
        assert len([f for f in files if f.endswith(".json") and not f.startswith(("upto-", "."))]) < 12 and any(f.startswith("upto-") for f in files)
    finally:
        log.detach()
        spark.conf.set(key, old)


def test_progress_is_read_while_reports_are_put_together(spark, tmp_dir):
    """What was listed is still read after the log has put the files together; a folder without a report yet is no error."""
    import threading

    path = f"{tmp_dir}/progress"
    log = progress.ProgressLog(spark, path, fold_every=4)
    report = lambda i: log._store("q", str(i), {"query": "q", "batch": i, "time": f"{i:03d}", "rows_read": 1, "lines": 2})
    lines = lambda rows: rows.agg(F.sum("lines")).first()[0]
    os.makedirs(f"{path}/query=q")
    assert progress.read_progress(spark, path).count() == 0
    for i in range(3):
        report(i)
    before = progress.read_progress(spark, path)
    for i in range(3, 9):                               # put together at 3 and at 7
        report(i)
    assert lines(before) == 6 and lines(progress.read_progress(spark, path)) == 18
    assert sorted(os.path.basename(f) for f in os.listdir(f"{path}/query=q") if not f.startswith(".")) == ["8.json", "upto-3.json", "upto-7.json"]

    writer = threading.Thread(target=lambda: [report(i) for i in range(9, 40)])
    writer.start()
    seen = []
    while writer.is_alive():
        seen.append(lines(progress.read_progress(spark, path)))
    assert lines(progress.read_progress(spark, path)) == 80 and seen == sorted(seen) and seen[0] >= 18


def test_failed_run_is_noted(spark, tmp_dir):
    import pytest
    src = f"{tmp_dir}/in"
    write_lines(src, "f.txt", [_post(1, 1)])
    log = progress.ProgressLog(spark, f"{tmp_dir}/progress").attach()
    try:
        def fail(batch, epoch):
            raise ValueError("no room")
        q = spark.readStream.text(src).writeStream.foreachBatch(fail).option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start()
        with pytest.raises(Exception, match="no room"):
            q.awaitTermination()
        import time
        for _ in range(50):
            got = progress.totals(spark, f"{tmp_dir}/progress").collect()
            if got:
                break
            time.sleep(0.2)
        assert [r["failed"] for r in got] == [1]
    finally:
        log.detach()
