"""Every report against its SQL on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from candlewright.queries import load

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
REPORTS, SQL = load()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def cell(value):
    if isinstance(value, float):
        return "null" if value != value else repr(value)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return "null" if value is None else str(value)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([cell(r[i]) for i in order] for r in rows)


def test_every_report_has_sql():
    assert set(SQL) == set(REPORTS) and len(REPORTS) > 60
    assert set(entry_point.queries()) >= set(REPORTS) and set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_equals_sql(spark, duck, name):
    frame = REPORTS[name](spark, SF_DIR)
    result = duck.execute(SQL[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    assert table(frame.columns, [tuple(r) for r in frame.collect()]) == expected
