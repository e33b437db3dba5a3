"""Every query against its DuckDB statement."""


import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) & set(entry.oracle_sql())))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(repr(r[c]) for c in columns) for r in df.collect())
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == columns
    types = {c: TYPES.get(str(t), str(t)) for c, t in zip(want.columns, want.types)}
    assert types == {c: t for c, t in df.dtypes}
    at = [want.columns.index(c) for c in columns]
    assert got == sorted(tuple(repr(r[i]) for i in at) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
