"""Every registered query against its DuckDB oracle SQL on the small tables."""

import datetime
import decimal
import hashlib
import json
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL_SF
from oracle_sql import oracle_sql
from vigia.plans.catalog import queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(json.dumps([_norm(r[i]) for i in order], default=str, ensure_ascii=False) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL_SF}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    missing = set(queries()) - set(oracle_sql())
    assert missing == set(), missing


def test_the_entry_holds_them_all():
    assert set(queries()) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SMALL_SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    a, b = _digest(df.columns, rows), _digest(ocols, orows)
    assert hashlib.sha256("\n".join(a).encode()).hexdigest() == hashlib.sha256("\n".join(b).encode()).hexdigest()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_notificacoes" in df.columns
