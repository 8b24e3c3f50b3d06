"""The correctness gate in the test suite: every SQL twin against its Spark query (sf0.001).

Columns are matched by name, rows as an order-free multiset, values exactly, and
the Python type of every non-null value must agree.
"""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    yield c
    c.close()


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    values = Counter(tuple(r[i] for i in order) for r in rows)
    types = {cols[i]: {type(r[i]).__name__ for r in rows if r[i] is not None} for i in order}
    return sorted(cols), values, types


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_vals, s_types = _canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = con.execute(entry.oracle_sql()[name])
    d_cols, d_vals, d_types = _canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert s_types == d_types
    assert sum(s_vals.values()) == sum(d_vals.values())
    assert s_vals == d_vals
