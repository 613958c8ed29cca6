"""Every registered query that has SQL against DuckDB on the same tables; the others must run and give rows."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb
import pytest

from hexpanel.plans import panel_queries, registry, scan_queries, spatial_queries  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def told(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return str(v.replace(tzinfo=None))
    if isinstance(v, list | tuple):
        return str([told(x) for x in v])
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sql, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(tuple(told(v) for v in r) for r in df.select(*(f"`{c}`" for c in columns)).collect())
    if name not in registry.ORACLES:
        assert rows
        return
    found = sql.execute(registry.ORACLES[name])
    theirs = [x[0] for x in found.description]
    assert columns == sorted(theirs)
    at = [theirs.index(c) for c in columns]
    assert rows == sorted(tuple(told(r[i]) for i in at) for r in found.fetchall())


def test_entry_has_the_queries():
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
