"""Every registered batch query against its SQL on DuckDB; the entry contract."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry  # noqa: E402
from check_oracles import bag  # noqa: E402

from sparkstream.tables import TABLES, path_of  # noqa: E402

BATCH = [n for n in entry.queries() if n in entry.oracle_sql() and not n.startswith("stream_")]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path_of('/root/testdata/sf0.001', table)}'")
    return con


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_its_sql(spark, sf_dir, duck, name):
    got = entry.queries()[name](spark, sf_dir)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert bag(got.columns, got.collect()) == bag(want.columns, want.fetchall())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_chunked_snapshot_parses_its_feed_once(spark, sf_dir):
    plan = entry.queries()["cdc_chunked_snapshot"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "from_json" not in plan
