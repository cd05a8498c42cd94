"""Benchmark: prints ONE JSON line with per-query seconds.

Layout measured (the production layout, SURVEY T5 "parse once"):
  land      envelope lines built by Spark from events+documents, written as text files (input prep)
  ingest    text files -> parse, validate, score sentiment -> one table, kind=post|reject / date (1 pass)
  A1..A8    each metric from the posts table (column pruning and filter pushdown into Parquet)
  A9        roster from customer -> dedup -> rule chunks
  e2e_A3    the catalog's posts_by_hour_party: tables -> envelopes -> parse -> hourly counts, one plan
  stream    availableNow streaming ingest (4 files per batch), then the A3 stream with its upsert sink
``value`` is the sum of ingest, A1..A9, e2e_A3 and stream (land excluded: it only prepares input).
``llm_queries``: seconds of the operators for training data over the same tables (``op*`` and ``pipeline``, if the subpackage is
there), one after the other until BENCH_LLM_SECONDS (default 240) are used up; they don't count in ``value``.
Before timing, the same code paths run once untimed over the sf0.01 tables (JIT warm-up, as a
long-running cluster would be); set BENCH_WARMUP=0 to skip it.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_LLM_SECONDS
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from postwave.functions.timekeys import utc_date  # noqa: E402
from postwave.operators import lastn, metrics as M, parse  # noqa: E402
from postwave.operators.rules import roster_rules  # noqa: E402
from postwave.plans import catalog  # noqa: E402
from postwave.session import build_session, scratch_path  # noqa: E402
from postwave.sources import roster, tables  # noqa: E402
from postwave.streaming import queries as SQ  # noqa: E402
from postwave.streaming.catalog import land_envelopes  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sf = sf_dir.rsplit("sf", 1)[-1]
    # scratch tables go under spark.checkpoint.dir (from the Spark defaults; a temporary folder
    # only when a local session has none)
    spark = build_session(master=f"local[{cpus}]", app="postwave-bench", shuffle_partitions=max(8, cpus * 2))
    times: dict[str, float] = {}
    counts: dict[str, int] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        if isinstance(out, int):
            counts[name] = out
        print(f"[bench] {name}: {times[name]}s {out if isinstance(out, int) else ''}", file=sys.stderr, flush=True)
        return out

    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    warmed = os.environ.get("BENCH_WARMUP", "1") != "0" and os.path.isdir(warm_dir) and warm_dir != sf_dir
    if warmed:
        t0 = time.time()
        w_src = land_envelopes(spark, warm_dir, n_files=4)
        w_rows = parse.classify(parse.parse_lines(spark.read.text(w_src)))
        w_rows.write.format("noop").mode("overwrite").save()
        catalog.BATCH_QUERIES["posts_by_hour_party"](spark, warm_dir).collect()
        print(f"[bench] warm-up {time.time() - t0:.1f}s (untimed)", file=sys.stderr, flush=True)

    src = timed("land", lambda: land_envelopes(spark, sf_dir, n_files=max(8, cpus * 2)))
    out = scratch_path(spark, "bench")
    table = f"{out}/envelopes"

    def ingest():
        rows = parse.classify(parse.parse_lines(spark.read.text(src))).withColumn("date", utc_date(F.col("created_ts")))
        rows.write.mode("overwrite").partitionBy("kind", "date").parquet(table)
        return SQ.read_posts(spark, table).count()

    timed("ingest", ingest)
    posts = SQ.read_posts(spark, table)
    for spec in M.STANDARD_SPECS:
        timed(spec.name, lambda s=spec: len(M.metric_from_spec(posts, s).collect()))
    timed("media_by_hour_party",
          lambda: len(M.media_by_hour_party(M.metric_from_spec(posts, M.MEDIA_BY_KIND_HOUR_PARTY)).collect()))
    timed("last15_by_party", lambda: len(lastn.last_n_by_party(posts).collect()))
    timed("last15_combined", lambda: len(lastn.last_n_combined(posts).collect()))
    timed("roster_rules", lambda: len(roster_rules(roster.dedup_roster(roster.load_roster(
        tables.roster_lines(spark, sf_dir)))).collect()))
    timed("e2e_posts_by_hour_party", lambda: len(catalog.BATCH_QUERIES["posts_by_hour_party"](spark, sf_dir).collect()))

    s_out = scratch_path(spark, "bench-stream")

    def stream_ingest():
        SQ.start_ingest(spark, src, f"{s_out}/posts", f"{s_out}/ck_i", available_now=True,
                        max_files_per_trigger=4).awaitTermination()
        return SQ.read_posts(spark, f"{s_out}/posts").count()

    def stream_a3():
        SQ.start_metric(spark, f"{s_out}/posts", M.POSTS_BY_HOUR_PARTY, f"{s_out}/a3", f"{s_out}/ck_a3",
                        available_now=True).awaitTermination()
        return SQ.read_metric(spark, f"{s_out}/a3", M.POSTS_BY_HOUR_PARTY).count()

    timed("stream_ingest", stream_ingest)
    timed("stream_posts_by_hour_party", stream_a3)
    llm: dict[str, float] = {}
    until = time.time() + float(os.environ.get("BENCH_LLM_SECONDS", "240"))
    entry = __import__("__spark_entry__").queries()
    for name in sorted((n for n in entry if n.startswith("op") or n == "pipeline"), key=lambda n: (not n.startswith("op"), int("".join(filter(str.isdigit, n.split("_")[0])) or 0))):
        if time.time() < until:
            t0 = time.time()
            entry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            llm[name] = round(time.time() - t0, 3)
            print(f"[bench] {name}: {llm[name]}s", file=sys.stderr, flush=True)
    total = round(sum(v for k, v in times.items() if k != "land"), 3)
    lines = counts.get("ingest", 0)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times, "llm_queries": llm, "sf": sf,
                      "cpus": cpus, "valid_posts": lines, "warmup": "sf0.01 untimed" if warmed else "none",
                      "ingest_posts_per_sec": round(lines / times["ingest"], 1) if times.get("ingest") else None}))
    spark.stop()


if __name__ == "__main__":
    main()
