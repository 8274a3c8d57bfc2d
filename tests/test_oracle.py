"""Every registered query against its DuckDB twin on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.check_oracle import TABLES, digest, type_diffs

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.sql(ORACLE[name])
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(res.columns)
    assert type_diffs(sdf, res) == []
    assert len(srows) == len(drows)
    assert digest(srows, sdf.columns)[0] == digest(drows, res.columns)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["station_id", "temperature"]


def test_every_query_has_docstring():
    for name, fn in QUERIES.items():
        assert fn.__doc__, name
