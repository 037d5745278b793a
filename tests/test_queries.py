"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import datetime
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from feedloom_queries import all_oracles, all_queries

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="the tables are not here")
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.datetime) and value.tzinfo:
        return value.astimezone(datetime.UTC).replace(tzinfo=None)
    return bytes(value) if isinstance(value, bytearray) else value


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, str(SF_DIR))
    result = duck.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(names)
    order = sorted(names)
    found = sorted((tuple(plain(row[n]) for n in order) for row in frame.collect()), key=repr)
    picks = [names.index(n) for n in order]
    expected = sorted((tuple(plain(row[i]) for i in picks) for row in result.fetchall()), key=repr)
    assert found == expected


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
