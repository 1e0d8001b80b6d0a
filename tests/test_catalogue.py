"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from stratiform.plans.catalogue import QUERIES
from stratiform.plans.oracle import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def database_of_tables():
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_query(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "date" and df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, database_of_tables, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = database_of_tables.sql(ORACLE_SQL[name])
    assert by_name(df.columns, df.collect()) == by_name(relation.columns, relation.fetchall())
