"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import pytest

from checks.catalogue import QUERIES, SQL

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
}


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _sorted(rows):
    def rank(row):
        return [(v is None, "" if v is None else v) for v in row]

    return sorted(rows, key=rank)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    rows = [tuple(r) for r in found.select(*columns).collect()]
    cursor = duck.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})")
    kinds = [str(d[1]) for d in cursor.description]
    expected = cursor.fetchall()
    assert sorted(c[0] for c in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()) == columns
    assert [KINDS[dict(found.dtypes)[c]] for c in columns] == kinds
    assert _sorted(rows) == _sorted(expected)
    assert rows and not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)
