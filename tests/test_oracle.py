"""Every registered query against its DuckDB oracle SQL on the shared tables (sf0.001)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from riskweave.plans.bound import REGISTRY as QUERIES
from riskweave.plans.oracle import ORACLE
from riskweave.sources.tables import SHARED_TABLES, table_path
from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in SHARED_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    yield con
    con.close()


# taking links one by one is a loop; SQL for it needs minutes on whole tables (test_clustering has the brute force)
NO_SQL = {"cluster_records"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) - NO_SQL == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLE[name])
    want = _canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 100 and "resolution_impact" in df.columns
