"""Every registered query against its DuckDB oracle on sf0.001."""

import hashlib
import math

import duckdb
import pytest

from conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)  # exact: results are order-independent
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _names():
    from paylake.plans.queries import REGISTRY
    return sorted(REGISTRY)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    sql = oracle_sql()
    assert name in sql, f"{name} has no oracle"
    df = queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, df.columns) == _digest(drows, dcols)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["transaction_date", "total_transactions", "successful_transactions",
                          "total_gtv_idr", "overall_success_rate_pct"]
