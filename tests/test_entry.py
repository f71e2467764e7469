import os
from decimal import Decimal

import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data here")
#: One query of every kind of operator; the driver compares all of them.
QUICK = ("p4_found", "p5_found", "p6_found", "p7_found", "scd2_history", "latest_wins_merge", "payload_unparsed", "completeness_by_day", "reconcile_resolved", "table_history")


def test_every_sql_has_its_query():
    queries = driver.queries()
    assert set(driver.oracle_sql()) <= set(queries)
    assert {f"p{n}_found" for n in range(1, 8)} <= set(queries)


@needs_data
def test_entry(spark):
    assert driver.entry(spark).count() > 0


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: float(v) if isinstance(v, Decimal) else v
    return sorted((tuple(str(plain(r[i])) for i in order) for r in rows))


@needs_data
@pytest.mark.parametrize("name", QUICK)
def test_same_as_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    got = driver.queries()[name](spark, FOLDER)
    want = con.execute(driver.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert _rows(got.columns, got.collect()) == _rows(names, want.fetchall())
