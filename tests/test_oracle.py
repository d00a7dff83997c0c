"""Every registered query against its DuckDB statement on the same tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from kiln.tables import TABLES

SQL = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def test_every_query_has_a_check():
    own = E._registry()
    assert set(own.QUERIES) - set(own.ORACLE) == {"knn_lsh"}  # approximate: see the recall tests
    assert set(own.ORACLE) <= set(own.QUERIES)


@pytest.mark.parametrize("name", sorted(E._registry().ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, drows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 1
    assert "success_rate" in df.columns
