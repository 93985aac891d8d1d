"""Every registered query against its SQL in DuckDB, over the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from converge import queries

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.is_dir(), reason="no shared tables here")


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return str(value) if hasattr(value, "isoformat") or not isinstance(value, (int, str, bool, type(None))) else value


def rows(columns, values):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(v[i]) for i in at] for v in values), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.iterdir():
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows(name, spark, duck):
    got = queries.QUERIES[name](spark, str(SF))
    wanted = duck.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows(got.columns, got.collect()) == rows(columns, wanted.fetchall())


def test_every_query_is_registered_with_sql():
    assert set(queries.QUERIES) == set(queries.ORACLE_SQL)
