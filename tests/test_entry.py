"""Driver contract: entry(), queries() and oracle_sql() line up; a few
queries against DuckDB at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["Key", "Count"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 60


@pytest.mark.parametrize("name", ["log_scan", "reject_lines", "set_bits", "topn", "nested", "ingest_report",
                                  "assign_column_ids", "open_shards"])
def test_oracle_matches_at_sf0001(spark, name):
    con = duckdb.connect()
    for t in ("events",):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t)}.parquet')")
    want = sorted(map(tuple, con.execute(E.oracle_sql()[name]).fetchall()), key=str)
    df = E.queries()[name](spark, SF001)
    cols = [d[0] for d in con.execute(E.oracle_sql()[name]).description]
    assert sorted(df.columns) == sorted(cols)
    got = sorted(map(tuple, df.select(*cols).collect()), key=str)
    assert got == want
