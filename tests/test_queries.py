"""Every registered query against its SQL counterpart, run by an independent engine."""

import glob
import os

import duckdb
import pandas as pd
import pytest
from conftest import SF_DIR

from kilnwatt.checks.oracle import ORACLE
from kilnwatt.checks.queries import QUERIES

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if value is None or value is pd.NaT or value != value:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(pd.Timestamp(value)) if hasattr(value, "year") else str(value)


def sorted_rows(rows, names, order):
    at = [names.index(n) for n in order]
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=str)


def test_same_keys():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert {n: KINDS[k] for n, k in df.dtypes} == types
    order = sorted(types)
    want = sorted_rows(result.fetchall(), list(types), order)
    assert sorted_rows([tuple(r) for r in df.collect()], df.columns, order) == want
