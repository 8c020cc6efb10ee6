"""Every registered query against its DuckDB statement, over whole tables."""

import duckdb
import pytest

from claimtide.oracle import oracle_sql
from claimtide.queries import queries
from comparing import bag, plain
from conftest import SMALL

_DUCK_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')"
        )
    return connection


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    result = queries()[name](spark, SMALL)
    expected = duck.execute(oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in expected.description}
    columns = sorted(types)
    assert sorted(result.columns) == columns
    for field in result.schema:
        kind = field.dataType.simpleString()
        assert _DUCK_TYPES.get(kind, kind.upper()) == types[field.name], field.name
    order = [list(types).index(c) for c in columns]
    rows = sorted([plain(row[i]) for i in order] for row in expected.fetchall())
    assert rows and bag(result) == rows
