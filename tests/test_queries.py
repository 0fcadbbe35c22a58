"""Every query against its SQL on the smallest data, and the library without the optional subpackage."""

import importlib.util
import math
import os
import subprocess
import sys

import duckdb
import pytest

from folioforge.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    if hasattr(x, "replace") and hasattr(x, "tzinfo"):
        return x.replace(tzinfo=None)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


def compare(spark, run, sql, sf):
    df = run(spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if sql is None:
        return
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(sf):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{sf}/{f}')")
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in res.fetchall()), key=str)
    assert got == want


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, name):
    compare(spark, catalogue.QUERIES[name], catalogue.ORACLES.get(name), SF)


def test_core_stands_alone():
    code = "import sys; sys.modules['folioforge.llm'] = None\nimport __spark_entry__ as e\nq = e.queries()\nassert 'p3_found' in q and 'p1_found' not in q and set(e.oracle_sql()) <= set(q)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
    assert importlib.util.find_spec("folioforge.plans")
