"""Every registered query against its SQL on the smallest data set, value for value."""

import os
from types import SimpleNamespace

import duckdb
import pytest

import __spark_entry__ as entry
from tallyframe.plans import oracle as _oracle
from tallyframe.plans import queries as _queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(repr(row[i]) for i in order) for row in rows)


OWN = _queries.queries()


def test_every_query_has_sql():
    assert OWN.keys() == _oracle.oracle_sql().keys()


@pytest.mark.parametrize("name", list(OWN))
def test_query(spark, database, name):
    result = entry.queries()[name](spark, SF_DIR)
    expected = database.execute(entry.oracle_sql()[name])
    columns, rows = [d[0] for d in expected.description], expected.fetchall()
    assert in_order(result.columns, [tuple(r) for r in result.collect()]) == in_order(columns, rows)
    assert rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["database_marts", "jdbc_roundtrip"])
@pytest.mark.parametrize("master", ["local-cluster[3,4,1024]", "spark://host:7077"])
def test_executors_of_their_own_need_a_named_database(monkeypatch, name, master):
    """The embedded database of one process is not what another one writes to; nothing is read or written before that is told."""
    monkeypatch.delenv("TALLYFRAME_JDBC_URL", raising=False)
    session = SimpleNamespace(sparkContext=SimpleNamespace(master=master))
    with pytest.raises(RuntimeError, match="TALLYFRAME_JDBC_URL"):
        OWN[name](session, SF_DIR)
