"""The registered queries over the smallest tables: against their SQL, or for their rows and columns."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from candlewright.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
KEY = {"op4_template_deduction": ("pages", "page_id"), "op7_chat_windows": ("conversations", "conv_id"), "op13_conversation_repair": ("conversations", "conv_id")}
EXTRA = {"op7_chat_windows": {-1}}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("benchmark", "documents", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_point.queries()) and SQL.items() <= entry_point.oracle_sql().items()
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_over_tables(spark, duck, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    if name in SQL:
        result = duck.execute(SQL[name])
        names = [c[0] for c in result.description]
        assert sorted(repr(tuple(r[c] for c in names)) for r in rows) == sorted(map(repr, result.fetchall()))
        return
    table, key = KEY.get(name, ("documents", "doc_id"))
    ids = {i for (i,) in duck.execute(f"SELECT {key} FROM {table}").fetchall()} | EXTRA.get(name, set())
    found = {r[key] for r in rows}
    assert found <= ids if name == "pipeline" else found == ids
    assert len(rows) == len(ids) or name == "pipeline"
