"""Every query with SQL gives the same rows in Spark and DuckDB; the others run and give rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

QUERIES = contract.queries()
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else f"{value:.9g}")
    return (1, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


SAME_TYPE = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, sf_dir, duck):
    got = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLE[name])
    want_types = {d[0]: str(d[1]) for d in want.description}
    assert {c: SAME_TYPE[t] for c, t in got.dtypes} == want_types
    want_rows = want.fetchall()
    assert _rows(got.columns, got.collect()) == _rows(list(want_types), want_rows)
    assert want_rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r["channel_id"] for r in rows} == {"ATM", "Online", "Mobile", "Branch"}
