"""Every query of the subpackage runs on the small tables, and those that have SQL give the rows that DuckDB gives."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from palimpsest.llm import bpe, queries


def plain(v):
    return round(v, 6) if isinstance(v, float) else tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{data}/*.parquet"):
        c.execute(f"CREATE VIEW {p.split('/')[-1][:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, con, data, name):
    if name.startswith(("p8", "p9")) and not os.path.exists(bpe.VOCABULARY):
        pytest.skip("no vocabulary here")
    df = queries.queries()[name](spark, data)
    rows = df.collect()
    sql = queries.oracle_sql().get(name)
    if sql is None:
        return
    rel = con.sql(sql)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [list(rel.columns).index(c) for c in cols]
    want = Counter(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
    assert Counter(tuple(plain(r[c]) for c in cols) for r in rows) == want
