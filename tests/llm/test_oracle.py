"""Queries with a DuckDB twin: rows, names, types and values on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as E
from runledger.llm import queries
from runledger.plans.tables import TABLES
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_one_query_per_operator_and_the_pipeline():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in names if q.startswith("op")}
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(cols, want)[0]
