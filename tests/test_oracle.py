"""Every registered query runs on the smallest tables; those with an SQL twin give the same rows."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    made.execute("SET TimeZone='UTC'")
    for t in TABLES:
        made.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return made


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, FOLDER)
    names = sorted(frame.columns)
    mine = [tuple(plain(row[c]) for c in names) for row in frame.collect()]
    spark.catalog.clearCache()
    if name not in SQL:
        assert mine
        return
    result = con.execute(SQL[name])
    found = [d[0] for d in result.description]
    assert sorted(found) == names
    theirs = [tuple(plain(row[found.index(c)]) for c in names) for row in result.fetchall()]
    order = lambda row: tuple((v is None, str(v)) for v in row)
    assert sorted(mine, key=order) == sorted(theirs, key=order)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
