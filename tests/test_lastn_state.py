"""Last n as keyed state against the batch form."""

import time

from postwave.operators import lastn
from postwave.streaming import queries as SQ
from tests.test_streaming import _post, rows, write_lines

COLS = ["party", "recency", "id"]


def test_state_equals_batch_over_restarts_repeats_and_any_order(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", tmp_dir
    for lot in range(3):                            # later lots hold older posts as well, and the same posts again
        lines = [_post(i, (7 * i + lot) % 24, i % 60, party="pqr"[i % 3]) for i in range(40 * lot, 40 * lot + 60)] + [_post(5, 23, 59, party="p")] * 2
        write_lines(src, f"f{lot}.txt", lines)
        SQ.start_ingest(spark, src, f"{out}/posts", f"{out}/ck_i", available_now=True).awaitTermination()
        SQ.start_last_n_state(spark, f"{out}/posts", f"{out}/l15", f"{out}/ck", available_now=True, max_files_per_trigger=1, state_partitions=2).awaitTermination()
        posts = SQ.read_posts(spark, f"{out}/posts")
        got = SQ.read_last_n_state(spark, f"{out}/l15")
        assert rows(got.where("scope = 'party'"), COLS) == rows(lastn.last_n_by_party(posts), COLS)
        assert rows(got.where("scope = 'combined'"), COLS[1:]) == rows(lastn.last_n_combined(posts), COLS[1:])


def test_timer_sends_a_party_once_in_a_while(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", tmp_dir
    write_lines(src, "f0.txt", [_post(i, i, party="p") for i in range(3)])
    SQ.start_ingest(spark, src, f"{out}/posts", f"{out}/ck_i", available_now=True).awaitTermination()
    q = SQ.start_last_n_state(spark, f"{out}/posts", f"{out}/l15", f"{out}/ck", interval="1 second", every_ms=500, state_partitions=1)
    try:
        for _ in range(100):
            got = SQ.read_last_n_state(spark, f"{out}/l15")
            if got is not None and got.where("scope = 'party'").count() == 3:
                break
            time.sleep(1)
        assert rows(got.where("scope = 'party'"), COLS) == [("p", 1, "2"), ("p", 2, "1"), ("p", 3, "0")]
    finally:
        q.stop()
