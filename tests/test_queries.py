"""Every registered query against its SQL, on the smallest driver tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        ([plain(r[i]) for i in order] for r in rows), key=lambda r: [x or "" for x in r]
    )


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(entry.oracle_sql()[name])
    want = table([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want
    assert len(got[1]) > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "weather_status" in df.columns
