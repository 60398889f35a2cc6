"""Every pN_found query on tables that are empty, that have rows of nulls and repeated rows, and that have columns of all names used
inside: it neither fails nor changes its result."""

import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from palimpsest.llm import bpe, queries
from palimpsest.session import release_all

NAMES = [n for n in queries.queries() if n.endswith(("_found", "_ids", "_mixture"))]
USED = "id text run n split level over key rank h row best dim who source_table content cell bucket label band host rep class size".split()


def with_nulls(t):
    none = pa.table({c.name: pa.nulls(3, c.type) for c in t.schema}, schema=t.schema)
    return pa.concat_tables([t, none, t.slice(0, 2)])


def with_columns(t):
    for c in USED:
        if c not in t.column_names:
            t = t.append_column(c, pa.array(["x"] * t.num_rows))
    return t


FORMS = {"empty": lambda t: t.slice(0, 0), "nulls": with_nulls, "columns": with_columns}


@pytest.fixture(scope="module")
def forms(data, tmp_path_factory):
    out = {}
    for name, change in FORMS.items():
        out[name] = tmp_path_factory.mktemp(name)
        for p in glob.glob(f"{data}/*.parquet"):
            pq.write_table(change(pq.read_table(p)), out[name] / os.path.basename(p))
    return out


@pytest.mark.parametrize("name", NAMES)
def test_tables(spark, data, forms, name):
    if name.startswith(("p8", "p9")) and not os.path.exists(bpe.VOCABULARY):
        pytest.skip("no vocabulary here")
    rows = lambda d: sorted(str(r) for r in queries.queries()[name](spark, str(d)).collect())
    want = rows(data)
    assert rows(forms["empty"]) == []
    assert rows(forms["nulls"]) == want
    assert rows(forms["columns"]) == want
    release_all(spark)
