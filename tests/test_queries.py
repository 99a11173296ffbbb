"""Every registered query equals its SQL.

All queries share one set of inputs, which saves most of the time; ``check.py`` runs
each on inputs of its own.
"""

import duckdb
import pytest

from check import TABLES, rows
from querybook import BUILDERS, ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(inputs, db, name):
    df = BUILDERS[name](inputs)
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, result.fetchall())
