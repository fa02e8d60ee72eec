"""Every registered query against its DuckDB oracle on the smallest data set
(row count, column names, order-insensitive values)."""

import duckdb
import pytest

import __spark_entry__ as E
from runledger.plans import catalog
from runledger.plans.tables import TABLES
from tools.check_oracle import digest

from .conftest import SF_SMALL

QUERIES = dict(catalog.QUERIES)
ORACLE = dict(catalog.ORACLE)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema.fields} == types
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "run_date", "attempts", "failed_attempts", "final_status", "stop_reason"]
    assert df.count() > 0
