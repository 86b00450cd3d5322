"""Every query with SQL against that SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

D = "/root/testdata/sf0.001"


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: round(float(v), 6) if type(v).__name__ in ("float", "Decimal") else v
    return [names[i] for i in order], sorted(str(tuple(plain(r[i]) for i in order)) for r in data)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{D}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    got = entry.queries()[name](spark, D)
    r = con.execute(entry.oracle_sql()[name])
    assert rows(got.columns, got.collect()) == rows([c[0] for c in r.description], r.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
