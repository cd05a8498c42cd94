"""Run the whole application: ingest stream + all metric streams + last-15 stream.

    python -m postwave --source <folder of envelope files> --out <output folder> [--available-now]

Runs until stopped (Ctrl-C stops every query), or once over what is there with --available-now.
On a cluster, submit with spark-submit and pass the cluster settings (see postwave.session.cluster_conf);
what is set there stays.
"""

from __future__ import annotations

import argparse

from postwave.session import build_session
from postwave.streaming.queries import run_all, stop_all


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="postwave")
    ap.add_argument("--source", required=True, help="folder where envelope text files arrive")
    ap.add_argument("--out", required=True, help="folder for tables and checkpoints")
    ap.add_argument("--watermark", default=None, help="drop posts later than this (event time); default: drop none")
    ap.add_argument("--files-per-trigger", type=int, default=None, help="input files of one micro-batch at most")
    ap.add_argument("--processing-time", action="store_true", help="hours of arrival instead of event time")
    ap.add_argument("--output-mode", choices=("update", "complete"), default="update")
    ap.add_argument("--state-partitions", type=int, default=None, help="state stores of each metric stream")
    ap.add_argument("--spread", type=int, default=None, help="files of a batch per kind and date at most; default: by their size")
    ap.add_argument("--merged-delay", default=None, help="metrics without state: posts later than this, e.g. '1 hour', are added as corrections")
    ap.add_argument("--keyed-last-n", action="store_true", help="last 15 as keyed state")
    ap.add_argument("--fold-every", type=int, default=None, help="batches after which a metric's table is folded")
    ap.add_argument("--replay", action="store_true", help="the input holds captured replay lines")
    ap.add_argument("--interval", default=None, help="override every trigger interval, e.g. '30 seconds'")
    ap.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    ap.add_argument("--strict", action="store_true", help="reject non-string values in string fields")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session(master=args.master, app="postwave")
    handles = run_all(spark, args.source, args.out, watermark=args.watermark, available_now=args.available_now,
                      interval=args.interval, strict=args.strict, max_files_per_trigger=args.files_per_trigger,
                      processing_time=args.processing_time, output_mode=args.output_mode, replay=args.replay,
                      state_partitions=args.state_partitions, spread=args.spread, merged_delay=args.merged_delay, keyed_last_n=args.keyed_last_n,
                      **({"fold_every": args.fold_every} if args.fold_every else {}))
    try:
        if args.available_now:
            for q in handles.values():
                q.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    except KeyboardInterrupt:
        pass
    finally:
        stop_all(spark)
        spark.stop()


if __name__ == "__main__":
    main()
