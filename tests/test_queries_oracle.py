"""Every registered query against its DuckDB twin on the smallest driver tables
(the driver repeats this at sf0.01); queries without a twin must run."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import canon, digest
from tradelens.sources.tables import TABLES, table_path

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{table_path(SF, t)}')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "avg_target_expanding" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    d_rows = rel.fetchall()
    assert len(rows) == len(d_rows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, d_rows)[0]
    assert canon(None) is None
