"""Every registered query against its SQL on the same Parquet files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from shelfmark.showcase import ORACLE, QUERIES


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    picked = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((value is None, str(value)) for value in row))


SPARK_TO_SQL = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
                "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, database, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    expected = database.execute(ORACLE[name].strip().rstrip(";"))
    columns = {column[0]: str(column[1]) for column in expected.description}
    wanted = rows_by_name(list(columns), expected.fetchall())
    assert sorted(frame.columns) == sorted(columns)
    found = rows_by_name(frame.columns, [tuple(row) for row in frame.collect()])
    assert len(found) == len(wanted) > 0
    assert found == wanted
    described = {row[0]: row[1] for row in database.execute(f"DESCRIBE {ORACLE[name].strip().rstrip(';')}").fetchall()}
    assert {column: SPARK_TO_SQL[kind] for column, kind in frame.dtypes} == described


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
