"""Every registered query of the library against its DuckDB oracle on the smallest test tables (those of ``llm`` have tests of their own)."""

import duckdb
import pytest

import __spark_entry__ as E
from postwave.plans.catalog import BATCH_QUERIES
from postwave.plans.oracle import ORACLE
from postwave.streaming.catalog import STREAM_QUERIES
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


QUERIES = {**BATCH_QUERIES, **STREAM_QUERIES}


def norm(v):
    return repr(round(v, 9)) if isinstance(v, float) else repr(v)


def table(arrow):
    """Column names and sorted rows of an Arrow table; nulls stay apart from NaN."""
    cols = sorted(arrow.column_names)
    return cols, sorted(zip(*[[norm(v) for v in arrow.column(c).to_pylist()] for c in cols]))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "day", "hour", "party", "count"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = table(QUERIES[name](spark, SF_SMALL).toArrow())
    want = table(duck.sql(ORACLE[name]).to_arrow_table())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
