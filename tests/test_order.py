"""Shuffled input partitions give the same metrics."""

from pyspark.sql import functions as F

from postwave.operators import lastn, metrics as M, parse
from postwave.sources import tables
from tests.conftest import SF_SMALL


def as_set(df):
    out = set()
    for r in df.collect():
        out.add(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return out


def test_metrics_do_not_depend_on_input_order(spark):
    lines = tables.envelope_lines(spark, SF_SMALL).select("value").checkpoint(eager=True)
    shuffled = lines.orderBy(F.rand(7)).repartition(5)
    a = parse.parse_posts(lines.coalesce(1))
    b = parse.parse_posts(shuffled)
    for spec in M.STANDARD_SPECS:
        assert as_set(M.metric_from_spec(a, spec)) == as_set(M.metric_from_spec(b, spec)), spec.name
    assert as_set(lastn.last_n_by_party(a)) == as_set(lastn.last_n_by_party(b))
    assert as_set(lastn.last_n_combined(a)) == as_set(lastn.last_n_combined(b))
