"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from oracle import ORACLE
from shelfcast.operators import stats
from shelfcast.plans.queries import QUERIES, SPEC, typed_panel
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted(tuple(_norm(x) for x in r) for r in df.collect())
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 30
    assert df.columns[0] == "Demand"
    assert df.count() >= 0


def test_median_approx_close_to_exact(spark):
    typed = typed_panel(spark, SF_SMALL)
    approx = stats.approx_medians(typed, list(SPEC.typed_numerics))
    exact = stats.exact_medians(typed, list(SPEC.typed_numerics))
    assert approx.keys() == exact.keys()
    for k in exact:
        assert abs(approx[k] - exact[k]) <= 0.01 * max(1.0, abs(exact[k])) + 1e-9


def test_entry_schema_is_stable(spark):
    assert E.entry(spark).schema == E.entry(spark).schema
