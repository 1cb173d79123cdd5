"""Every query with an oracle SQL agrees with DuckDB at sf0.001; the
others run and return rows.  Also the driver's entry smoke check."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from panelkit.sources.tables import TABLES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(cols, rows):
    return sorted((tuple(norm(v) for v in r) for r in rows), key=repr)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_duckdb(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    srows = rows_of(cols, [tuple(r[c] for c in cols) for r in sdf.collect()])
    rel = con.sql(E.oracle_sql()[name])
    dcols = list(rel.columns)
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = rows_of(cols, [tuple(r[i] for i in idx) for r in rel.fetchall()])
    assert len(srows) == len(drows)
    assert srows == drows


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF001).count() > 0
