"""Every registered catalogue query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from docketry.plans import operator_queries as cq


def shown(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return str([shown(x) for x in v])
    return str(v)


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(cq.QUERIES))
def test_query(spark, data, con, name):
    df = cq.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    rows = sorted(tuple(map(shown, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if name in cq.ORACLES:
        want = con.sql("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({cq.ORACLES[name]})").fetchall()
        assert rows == sorted(tuple(map(shown, r)) for r in want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["facet", "value", "n"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
