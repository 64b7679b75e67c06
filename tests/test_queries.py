"""Every registered query against its SQL twin, on the smallest tables."""

import math
import os

import duckdb
import pytest

from workload import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return str(value)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[name])
    there = [d[0] for d in cursor.description]
    assert columns == sorted(there)
    want = sorted(tuple(plain(r[there.index(c)]) for c in columns) for r in cursor.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


def test_entry(spark):
    import __spark_entry__ as driver
    assert driver.entry(spark).count() > 0
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())
