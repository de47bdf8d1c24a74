"""Every registered query runs on the small tables, and equals its SQL twin where it has one."""

import duckdb
import pytest

from __spark_entry__ import FLAGSHIP, entry, oracle_sql, queries
from catalign.tables import TABLES
from check_queries import canonical

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toArrow()
    assert len(set(got.column_names)) == len(got.column_names)
    if name in ORACLES:
        want = duck.execute(ORACLES[name]).to_arrow_table()
        assert sorted(got.column_names) == sorted(want.column_names)
        assert canonical(got.to_pandas()) == canonical(want.to_pandas())


def test_entry_is_lazy_and_has_rows(spark):
    assert FLAGSHIP in QUERIES
    assert entry(spark).count() > 0
