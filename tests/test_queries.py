"""Every registered query against its SQL, on the smallest tables."""

import datetime
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from fiscora.queries import registry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="test tables are not here")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value) if isinstance(value, Decimal) else value


def ordered(names, records):
    picks = [names.index(n) for n in sorted(names)]
    return sorted((tuple(plain(r[i]) for i in picks) for r in records), key=repr)


registry.load_all()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, oracle, name):
    frame = entry_point.queries()[name](spark, str(DATA))
    found = ordered(frame.columns, frame.collect())
    cursor = oracle.execute(entry_point.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    assert found == ordered(names, cursor.fetchall())


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert len(frame.columns) == 29
    assert frame.count() > 0
