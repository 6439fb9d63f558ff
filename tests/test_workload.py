"""Every registered query against its SQL on the smallest test tables."""

import datetime
import decimal
from pathlib import Path

import pytest

import __spark_entry__

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    return value.isoformat() if isinstance(value, datetime.datetime) else value


@pytest.mark.parametrize("name", sorted(__spark_entry__.queries()))
def test_query(spark, database, name):
    got = __spark_entry__.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    found = sorted([tuple(plain(v) for v in r) for r in got.select(*columns).collect()], key=repr)
    sql = __spark_entry__.oracle_sql().get(name)
    if sql is None:
        assert found
        return
    relation = database.sql(sql)
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(c) for c in columns]
    expected = sorted([tuple(plain(r[i]) for i in places) for r in relation.fetchall()], key=repr)
    assert found == expected


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
