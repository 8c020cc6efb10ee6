"""A query's result against its DuckDB statement."""

import duckdb

from comparing import bag, plain

_KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def assert_same_as_duckdb(result, sql, folder):
    connection = duckdb.connect()
    for table in ("documents", "labels", "embeddings", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    expected = connection.execute(sql)
    kinds = {column[0]: str(column[1]) for column in expected.description}
    assert {f.name: _KINDS[f.dataType.simpleString()] for f in result.schema} == kinds
    order = [list(kinds).index(c) for c in sorted(kinds)]
    rows = sorted([plain(row[i]) for i in order] for row in expected.fetchall())
    assert rows and bag(result) == rows
