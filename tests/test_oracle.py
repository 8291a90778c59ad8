"""The correctness gate inside the suite: every registered query against its
DuckDB oracle at sf0.001 -- row count, column names, column types and an
order-free comparison of the values."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from claimsflow.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple("<null>" if r[i] is None else repr(r[i]) if isinstance(r[i], float) else str(r[i])
                        for i in order) for r in rows)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    duck.sql(f"CREATE OR REPLACE VIEW answer AS {entry.oracle_sql()[key]}")  # as the driver does
    rel = duck.sql("SELECT * FROM answer")
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    assert spark_types == duck_types
    assert _norm(df.collect(), df.columns) == _norm(rel.fetchall(), rel.columns)
