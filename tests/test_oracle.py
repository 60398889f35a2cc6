"""Every query of the core that has SQL gives the rows that DuckDB gives on the same tables."""

import glob
from collections import Counter

import duckdb
import pytest

from palimpsest.queries import registry


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "is_finite"):
        return float(v)
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{data}/*.parquet"):
        c.execute(f"CREATE VIEW {p.split('/')[-1][:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, data, name):
    df = registry.queries()[name](spark, data)
    rows = df.collect()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return
    rel = con.sql(sql)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [list(rel.columns).index(c) for c in cols]
    want = Counter(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
    assert Counter(tuple(plain(r[c]) for c in cols) for r in rows) == want
