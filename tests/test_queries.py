"""Every registered query of the ingest and lake operators against its oracle SQL."""

import os

import duckdb
import pytest

from larkspur import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, oracle, name):
    df = catalogue.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    if name in catalogue.ORACLE:
        want = oracle.sql(catalogue.ORACLE[name]).to_arrow_table()
        assert sorted(want.column_names) == cols
        rows = list(zip(*[want.column(c).to_pylist() for c in cols])) if want.num_rows else []
        assert got == sorted(rows, key=repr)


def test_non_finite_messages_of_odd_ids(spark, tmp_path):
    ids = [None, 0, 1, 2, 3, 4, 9, -1, -2, -5, -9, 10_000_003, 2**53 + 1, 2**62, -(2**62)]
    spark.createDataFrame([(i,) for i in ids], "event_id long").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = [tuple(r) for r in catalogue.QUERIES["non_finite_messages"](spark, str(tmp_path)).select("seq", "ratio", "is_nan", "text", "note").collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(catalogue.ORACLE["non_finite_messages"]).fetchall()
    assert sorted(got, key=repr) == sorted(want, key=repr)
